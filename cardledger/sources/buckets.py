"""Keyed masters in hash buckets, of which a change rewrites only the ones that it touches.

A table is a folder ``bucket=<b>/change=<n>``: a bucket is the rows whose keys have its hash, as of the
change that last touched it.  A change writes new folders beside the old ones and is published by the
marker of its number (as in ``snapshots``), so one that broke off leaves the table as it was, and a
repeated one starts again from the table before it: sums are not added twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger.session import job_folder, materialize
from cardledger.sources.snapshots import current_version, file_system, publish


@dataclass(frozen=True)
class BucketTable:
    """``buckets`` is fixed for a table; choose it so that a bucket is about a file's size.  Keys are
    unique, so no bucket is hot.  Columns must not be named ``bucket`` or ``change``."""

    root: str
    keys: tuple[str, ...]
    buckets: int

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def _folders(self, spark: SparkSession) -> dict[int, list[int]]:
        """The changes that each bucket has folders of, in order."""
        fs, jvm = file_system(spark, self.root)
        found: dict[int, list[int]] = {}
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/bucket=*/change=*")) or []:
            path = status.getPath()
            bucket = int(path.getParent().getName().removeprefix("bucket="))
            found.setdefault(bucket, []).append(int(path.getName().removeprefix("change=")))
        return {bucket: sorted(numbers) for bucket, numbers in found.items()}

    def _paths(self, spark: SparkSession, at: int, only: set[int] | None = None) -> list[str]:
        """Folders that make up the table after change ``at``."""
        last = {b: [n for n in numbers if n <= at] for b, numbers in self._folders(spark).items()}
        return [
            f"{self.root}/bucket={b}/change={numbers[-1]}"
            for b, numbers in sorted(last.items()) if numbers and (only is None or b in only)
        ]

    def write(self, df: DataFrame, change: int, keep: int = 2) -> None:
        """Write whole buckets as of ``change``, publish it and drop what the last ``keep`` changes
        do not need."""
        spark = df.sparkSession
        placed = df.select("*", self._bucket(), F.lit(change).alias("change")).repartition("bucket")
        # Folders of the same change only are replaced: those of an earlier try.
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket", "change"
        ).parquet(self.root)
        publish(spark, self.root, change, keep)
        self._delete(spark, f"_current.{change - keep}")
        for bucket, numbers in self._folders(spark).items():
            needed = max((n for n in numbers if n <= change - keep + 1), default=0)
            for old in [n for n in numbers if n < needed]:
                self._delete(spark, f"bucket={bucket}/change={old}")

    def _delete(self, spark: SparkSession, name: str) -> None:
        fs, jvm = file_system(spark, self.root)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}"), True)

    def change(
        self, delta: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], number: int,
        schema: T.StructType | None = None, keep: int = 2,
    ) -> list[int]:
        """Rewrite the buckets that the keys of ``delta`` fall into; returns them.

        ``merge(stored, delta)`` gives the new state of the stored rows; it may add and replace rows but
        take none away.  ``number`` follows that of the change before; repeating a change with its
        number gives the same table.  ``schema`` is that of the stored rows (default: of ``delta``).
        """
        spark = delta.sparkSession
        published = current_version(spark, self.root)
        if published is not None and number < published:
            raise ValueError(f"change {number} comes behind change {published}")
        for bucket, numbers in self._folders(spark).items():  # left by a change that broke off
            for lost in [n for n in numbers if published is None or n > published]:
                self._delete(spark, f"bucket={bucket}/change={lost}")
        with job_folder(spark):
            own = materialize(delta.select("*", self._bucket()), "delta")
            touched = sorted(r[0] for r in own.select("bucket").distinct().collect())  # at most ``buckets``
            own = own.drop("bucket")
            paths = self._paths(spark, number - 1, set(touched))
            shape = schema or own.schema
            stored = spark.read.schema(shape).parquet(*paths) if paths else spark.createDataFrame([], shape)
            self.write(merge(stored, own), number, keep)
        return touched

    def read(self, spark: SparkSession, at: int | None = None) -> DataFrame:
        """The table after the last change, or after change ``at`` if that is still kept."""
        number = current_version(spark, self.root) if at is None else at
        paths = [] if number is None else self._paths(spark, number)
        if not paths:
            raise FileNotFoundError(f"no table below {self.root}")
        return spark.read.parquet(*paths)
