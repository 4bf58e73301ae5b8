"""Dense numbering and neighbours over a total order, without sending a group to one task.

Inputs are range-partitioned and sorted on the (group, order) key and written once.  A row
then has a partition, called bucket, and a place in it; both are stored with it, so nothing depends
on a plan being computed the same way twice.  What crosses buckets is carried by one small row per
bucket, or per bucket and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardledger.session import materialize

ROWS_PER_BUCKET = 1_000_000
_OFFSET_BITS = 33  # monotonically_increasing_id: partition above, place in it below


def in_buckets(
    df: DataFrame, order: list[str], rows_per_bucket: int = ROWS_PER_BUCKET, store: bool = False
) -> DataFrame:
    """Add ``__bucket``, increasing along ``order`` (unique, not null), and ``__place`` in it, from 0.

    Counting reads no columns of a scan; ``store`` writes a computed input once first.
    """
    df = materialize(df, "input") if store else df
    buckets = max(2, -(-df.count() // rows_per_bucket))
    placed = df.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    stored = materialize(placed.withColumn("__pos", F.monotonically_increasing_id()), "ordered")
    pos = F.col("__pos")
    return stored.select(
        *df.columns,
        F.shiftright(pos, _OFFSET_BITS).cast("int").alias("__bucket"),
        pos.bitwiseAND(F.lit(2**_OFFSET_BITS - 1)).alias("__place"),
    )


def run_sequence(
    df: DataFrame, order: list[str], name: str = "seq_no", start: int = 1, **sizes: int
) -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order``, which must be unique and not null."""
    placed = in_buckets(df, order, **sizes)
    counts = placed.groupBy("__bucket").agg(F.count("*").alias("__n"))
    # One row per bucket of a million rows: a window without partitions.
    running = F.sum("__n").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0))
    shift = counts.select("__bucket", (running - F.col("__n")).alias("__shift"))
    return (
        placed.join(shift, "__bucket")
        .withColumn(name, F.col("__place") + F.col("__shift") + F.lit(start))
        .drop("__bucket", "__place", "__shift")
    )


def group_sequence(
    df: DataFrame, group: list[str], order: list[str], name: str = "row_no", **sizes: int
) -> DataFrame:
    """Add ``name`` = 1, 2, ... inside each group: the place among the group's rows of the same
    bucket, plus the group's rows in the buckets before."""
    placed = in_buckets(df, [*group, *order], **sizes)
    # A bucket is sorted, so a group's rows in it stand in a row from the group's first place on.
    counts = placed.groupBy("__bucket", *group).agg(F.count("*").alias("__n"), F.min("__place").alias("__at"))
    across = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__n").over(across), F.lit(0))
    shift = counts.withColumn("__shift", before - F.col("__at") + 1).drop("__n", "__at")
    return (
        placed.join(shift, ["__bucket", *group])
        .withColumn(name, F.col("__place") + F.col("__shift"))
        .drop("__shift", "__bucket", "__place")
    )


def last_before(
    df: DataFrame, group: list[str], order: list[str], value: Column, name: str, **sizes: int
) -> DataFrame:
    """Add ``name``: the last non-null ``value`` of the rows before this one in its group."""
    placed = in_buckets(df.withColumn("__v", value), [*group, *order], **sizes)
    earlier = (Window.unboundedPreceding, -1)
    part = Window.partitionBy("__bucket", *group).orderBy(*order).rowsBetween(*earlier)
    ends = placed.where(F.col("__v").isNotNull()).groupBy("__bucket", *group)
    ends = ends.agg(F.max_by("__v", F.struct(*order)).alias("__end"))
    spans = placed.select("__bucket", *group).distinct().join(ends, ["__bucket", *group], "left")
    across = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(*earlier)
    carry = spans.withColumn("__carry", F.last("__end", ignorenulls=True).over(across)).drop("__end")
    return (
        placed.withColumn("__own", F.last("__v", ignorenulls=True).over(part))
        .join(carry, ["__bucket", *group])
        .withColumn(name, F.coalesce("__own", "__carry"))
        .drop("__v", "__own", "__carry", "__bucket", "__place")
    )


def next_in_group(
    df: DataFrame, group: list[str], order: list[str], columns: list[str], name: str, **sizes: int
) -> DataFrame:
    """Add struct ``name``: ``columns`` of the following row of the same group, else NULL."""
    placed = in_buckets(df.withColumn("__row", F.struct(*columns)), [*group, *order], **sizes)
    part = Window.partitionBy("__bucket", *group).orderBy(*order)
    heads = placed.groupBy("__bucket", *group).agg(F.min_by("__row", F.struct(*order)).alias("__head"))
    across = Window.partitionBy(*group).orderBy("__bucket")
    carry = heads.withColumn("__carry", F.lead("__head").over(across)).drop("__head")
    return (
        placed.withColumn("__own", F.lead("__row").over(part))
        .join(carry, ["__bucket", *group])
        .withColumn(name, F.coalesce("__own", "__carry"))
        .drop("__row", "__own", "__carry", "__bucket", "__place")
    )


def first_of_group(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first row of each group (control break); combines on the map side."""
    rest = [c for c in df.columns if c not in {*group, *order}]
    head = df.groupBy(*group).agg(F.min(F.struct(*order, *rest)).alias("__h"))
    return head.select(*[c if c in group else F.col(f"__h.{c}") for c in df.columns])


def page_number(seq: Column, size: int = 20) -> Column:
    """Page of a row numbered from 1, ``size`` rows a page."""
    return F.floor((seq - 1) / size).cast("bigint") + 1


def next_key(df: DataFrame, order: list[str], highest: int, name: str = "new_id") -> DataFrame:
    """Number new rows behind the highest key in use."""
    return run_sequence(df, order, name, start=highest + 1)
