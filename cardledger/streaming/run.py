"""Starting bounded streaming runs."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Python workers reach the state over a file socket instead of a TCP port.
    "spark.python.unix.domain.socket.enabled": "true",
}


def configure_state(spark: SparkSession) -> None:
    """Set the state options; an option that only a new session can take is named in a warning."""
    for key, value in STATE_CONF.items():
        if spark.conf.get(key, None) == value:
            continue
        try:
            spark.conf.set(key, value)
        except AnalysisException:
            warnings.warn(f"{key} stays as it is; set it to {value} when building the session", stacklevel=2)


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int
) -> DataFrame:
    """Parquet files as a stream, ``files_per_batch`` at a time: what a micro-batch holds is bounded
    by it, also when a backlog waits."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_files(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process what is there, then stop (the bounded run).  Restarting goes on from the checkpoint.

    The file sink commits per batch, so a repeated batch is not written twice.
    """
    query = (
        df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return query


def run_batches(
    df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Bounded run that hands every micro-batch to ``each``; which must be idempotent by batch id."""
    query = (
        df.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
