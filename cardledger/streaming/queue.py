"""A message queue as a table of numbered rows, and runs that are bounded by messages or idleness.

Messages are appended as Parquet files with a dense ``offset``.  The source plans a micro-batch as ranges
of offsets, and a task reads its range through Arrow with the range as a filter.  Files consist of small row
groups, of which a task holds one at a time, so neither the number of files nor their size decides
what a run takes.  Files are opened by pyarrow: the queue can be
in any store it knows by URI.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from cardledger.operators.sequence import run_sequence
from cardledger.session import configure

OFFSET = "offset"
#: Messages that one task of a micro-batch reads.
MESSAGES_PER_TASK = 50_000
#: Bytes of a row group of the queue's files, and messages that are decoded at a time.
GROUP_BYTES = 2 << 20
MESSAGES_PER_BATCH = 10_000


def append_messages(df: DataFrame, queue: str, order: list[str], at: int = 0) -> None:
    """Append rows behind offset ``at`` (the number of messages there), numbered along ``order``."""
    numbered = run_sequence(df, order, OFFSET, start=at)
    numbered.write.mode("append").option("parquet.block.size", GROUP_BYTES).parquet(queue)


def waiting(spark: SparkSession, queue: str) -> int:
    """Number of messages ever appended: one behind the highest offset, from the files' statistics."""
    top = spark.read.parquet(queue).agg(F.max(OFFSET)).first()[0]
    return 0 if top is None else top + 1


@dataclass
class _Range(InputPartition):
    begin: int
    end: int


class _Reader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict) -> None:
        self._path, self._until = options["path"], int(options["until"])
        self._each = int(options["per_task"])
        self._schema = to_arrow_schema(schema)

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        """Admission: the run that starts this source says how far it may go."""
        return {"next": self._until}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        begins = range(start["next"], end["next"], self._each)
        return [_Range(b, min(b + self._each, end["next"])) for b in begins]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        found = pads.dataset(self._path.removeprefix("file:"), format="parquet")
        own = (pc.field(OFFSET) >= part.begin) & (pc.field(OFFSET) < part.end)
        # Nothing is read ahead: a task holds one row group.
        options = pads.ParquetFragmentScanOptions(use_buffered_stream=True, pre_buffer=False)
        batches = found.to_batches(
            filter=own, columns=self._schema.names, batch_size=MESSAGES_PER_BATCH, batch_readahead=0,
            fragment_readahead=0, fragment_scan_options=options, use_threads=False,
        )
        for batch in batches:
            if batch.num_rows:
                yield from pa.Table.from_batches([batch]).cast(self._schema, safe=False).to_batches()


class MessageQueue(DataSource):
    """``message_queue``: options ``path``, ``until`` (offset to stop before), ``per_task``."""

    @classmethod
    def name(cls) -> str:
        return "message_queue"

    def streamReader(self, schema: T.StructType) -> _Reader:
        return _Reader(schema, self.options)


def read_messages(spark: SparkSession, queue: str, schema: T.StructType, until: int) -> DataFrame:
    """The queue as a stream that ends before offset ``until``."""
    configure(spark).dataSource.register(MessageQueue)
    stream = spark.readStream.format("message_queue").schema(schema)
    return stream.option("until", until).option("per_task", MESSAGES_PER_TASK).load(queue)


def run_messages(
    spark: SparkSession,
    queue: str,
    job: Callable[[DataFrame], DataFrame],
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    most: int,
    wait_seconds: float = 0.0,
    mode: str = "append",
) -> int:
    """Process at most ``most`` messages, or fewer once none has come for ``wait_seconds``; returns
    how many.  The next run with the same checkpoint goes on behind them.

    ``job`` makes the output stream of the messages, ``each`` stores a micro-batch of it and must be
    idempotent by batch id.  The position is stored with the last micro-batch of a run; a run that
    broke off is repeated by its offsets, which Spark keeps in the checkpoint.
    """
    places = f"{checkpoint}/position"
    schema = spark.read.parquet(queue).schema
    first = position = _position(spark, places)
    idle_from = time.monotonic()
    while position - first < most:
        until = min(first + most, waiting(spark, queue))
        if until <= position:
            if time.monotonic() - idle_from >= wait_seconds:
                break
            time.sleep(min(1.0, wait_seconds))
            continue

        def write(batch: DataFrame, batch_id: int, until: int = until) -> None:
            each(batch, batch_id)
            place = spark.createDataFrame([(until,)], "position bigint").coalesce(1)
            place.write.mode("overwrite").parquet(f"{places}/batch={batch_id}")

        stream = job(read_messages(spark, queue, schema, until))
        query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{checkpoint}/stream")
        query.trigger(availableNow=True).start().awaitTermination()
        position, idle_from = until, time.monotonic()
    return position - first


def _position(spark: SparkSession, places: str) -> int:
    """Offset behind the last stored micro-batch: a row for each of them, reduced to one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(places)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return 0
    return spark.read.parquet(places).agg(F.max("position")).first()[0]
