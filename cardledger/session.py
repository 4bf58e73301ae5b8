"""Session helpers: configuration, the shared folder for materialised steps, size checks."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Options the jobs rely on.  Everything else is left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever the driver was started.  Once a context."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cardledger-package-")  # the driver serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime options the jobs rely on to an existing session."""
    ship_package(spark)
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables, visible to every executor.

    It is the session's ``spark.checkpoint.dir``.  Only a local session without that setting
    gets a folder of its own; a cluster without it is refused, since a folder on one machine
    would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if folder is None and current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="cardledger-")
    if current is None:
        sc.setCheckpointDir(folder)
        current = sc.getCheckpointDir()
    return folder or current


_jobs: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, or below the folder of the running job."""
    return f"{_jobs[-1] if _jobs else shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """Stored steps made inside live in one folder, which goes when the block ends.  Write the job's
    outputs inside the block: they are read from those steps."""
    folder = f"{shared_dir(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    _jobs.append(folder)
    try:
        yield folder
    finally:
        _jobs.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Compute once and cut the lineage: written to the shared folder and read back.

    A written table survives lost executors like a checkpoint does, and being columnar it lets
    later passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
