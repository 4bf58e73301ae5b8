"""Ledger backup and system transactions combined into the next ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def combine_transactions(
    ledger: DataFrame, system: DataFrame, key: str = "tran_id"
) -> tuple[DataFrame, DataFrame]:
    """The united ledger with one row per id, and the ids that occurred more than once.

    The ledger's own row stays when a system transaction repeats its id; among equals the
    smallest row (by column order) stays, so the outcome does not depend on file order.
    """
    shared = [c for c in ledger.columns if c in system.columns]
    both = (
        ledger.select(*shared, F.lit(0).alias("_from"))
        .unionByName(system.select(*shared, F.lit(1).alias("_from")))
    )
    rest = [c for c in shared if c != key]
    kept = both.groupBy(key).agg(
        F.min(F.struct("_from", *rest)).alias("_row"), F.count("*").alias("_rows")
    )
    united = kept.select(*[c if c == key else F.col(f"_row.{c}").alias(c) for c in shared])
    return united, kept.where(F.col("_rows") > 1).select(key, F.col("_rows").alias("rows"))


def sort_combined(df: DataFrame, key: str = "tran_id") -> DataFrame:
    return df.orderBy(key)
