"""Versioned snapshots of a table: write the next one, read the latest, keep the last N.

A table is a folder with ``v=<n>`` subfolders and an empty marker file ``_current.<n>`` per
published version.  The marker is made after the data is written, in one step, so a job lost
halfway leaves the previous version current.  A job with several outputs writes all of them first
(``publish_now=False``) and publishes them at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    fs, jvm = file_system(spark, root)
    path = jvm.org.apache.hadoop.fs.Path(root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())


def current_version(spark: SparkSession, root: str) -> int | None:
    """The latest published version."""
    fs, jvm = file_system(spark, root)
    path = jvm.org.apache.hadoop.fs.Path(root)
    if not fs.exists(path):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    marked = [int(n[9:]) for n in names if n.startswith("_current.") and n[9:].isdigit()]
    return max(marked, default=None)


def publish(spark: SparkSession, root: str, version: int, keep: int = 5) -> None:
    """Make a written version current and drop versions beyond the last ``keep``."""
    fs, jvm = file_system(spark, root)
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{root}/_current.{version}"), True).close()
    for old in [v for v in snapshot_versions(spark, root) if v <= version - keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/_current.{old}"), False)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/v={old}"), True)


def snapshot_write(
    df: DataFrame,
    root: str,
    keep: int = 5,
    partition_by: list[str] | None = None,
    publish_now: bool = True,
) -> int:
    """Write the next version and, unless told otherwise, publish it; returns its number."""
    spark = df.sparkSession
    version = max(snapshot_versions(spark, root), default=0) + 1
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/v={version}")
    if publish_now:
        publish(spark, root, version, keep)
    return version


def snapshot_read(spark: SparkSession, root: str, generation: int = 0) -> DataFrame:
    """Generation 0 is the latest, -1 the one before it."""
    current = current_version(spark, root)
    if current is None:
        raise FileNotFoundError(f"no snapshot below {root}")
    kept = [v for v in snapshot_versions(spark, root) if v <= current]
    return spark.read.parquet(f"{root}/v={kept[generation - 1]}")
