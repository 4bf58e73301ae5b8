"""Loading keyed masters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Equal rows that are written out together.
COPIES = 65_536


def load_replace(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row per key, and the refused rows: all others of the keys that occur more than once.

    The smallest row by column order stays, so the outcome does not depend on file order.  Rows are
    counted and keys reduced on the map side first, so a very common key or row does no harm.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest) if rest else F.struct(F.lit(0))
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    kept = df.groupBy(*keys).agg(F.min(row).alias("_kept"))
    good = kept.select(*[F.col(f"_kept.`{c}`").alias(c) if c in rest else F.col(c) for c in df.columns])
    both = counted.alias("r").join(kept.alias("k"), _same_keys(keys))
    stays = row_of("r", rest).eqNullSafe(F.col("k._kept")) if rest else F.lit(True)
    times = F.col("_n") - stays.cast("int")
    # Copies are numbered by blocks, which are dealt out before they become rows: any number of equal
    # rows is spread over the tasks, and no array is longer than a block.
    blocks = both.withColumn("_times", times).where("_times > 0")
    begin = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_times") - 1, F.lit(COPIES).cast("bigint")))
    blocks = blocks.withColumn("_begin", begin).repartition("_begin", *[F.col(f"r.`{k}`") for k in keys])
    size = F.least(F.col("_times") - F.col("_begin"), F.lit(COPIES)).cast("int")
    refused = blocks.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), size)))
    return good, refused.select(*[F.col(f"r.`{c}`").alias(c) for c in df.columns])


def row_of(side: str, columns: list[str]) -> Column:
    return F.struct(*[F.col(f"{side}.`{c}`").alias(c) for c in columns])


def _same_keys(keys: list[str]) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"r.`{key}`").eqNullSafe(F.col(f"k.`{key}`"))
    return same


def replace_table(df: DataFrame, keys: list[str], path: str) -> int:
    """Rewrite the stored master from ``df``; returns the number of refused rows."""
    good, refused = load_replace(df, keys)
    good.write.mode("overwrite").parquet(path)
    return refused.count()
