"""Helpers of the text operators: words, stored steps and rows that go through Arrow."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardledger.session import configure, materialize

#: What stands between words: every ASCII character but digits and small letters.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a batch that goes to Python, and rows of a batch that a scan decodes.  By Spark's own limits (10,000
#: and 4,096 rows) both hold tens of MB of texts, several times over, in the executor and in its workers.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read through Spark so that any store it knows will do."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """From now on the session reads and hands over few texts at a time.  Rows and results stay the same; it is not
    undone, since a frame is planned with the settings of the time it runs."""
    for key, value in SMALL_BATCHES.items():
        spark.conf.set(key, value)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is.  Texts of ASCII only take the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """Lower-cased words of a text in order; none for a null or empty text."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as soon as each write has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back; its shuffle files go at once."""
    with short_shuffles(df.sparkSession):
        return materialize(df, name)


def tasks(spark: SparkSession) -> int:
    """Partitions that a keyed shuffle is dealt to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
