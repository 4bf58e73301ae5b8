"""Root and child tables of the authorization store.

The two levels stay two flat tables: a root with very many children never becomes one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hier_unload(roots: DataFrame, children: DataFrame, key: str = "acct_id") -> tuple[DataFrame, DataFrame]:
    """Root rows, and child rows with their root key in front; children need a root."""
    kept = children.join(roots.select(key), key, "left_semi")
    columns = [c for c in children.columns if c != key]
    return roots, kept.select(F.col(key).alias("root_key"), *columns)


def hier_load(
    roots: DataFrame, children: DataFrame, child_key: list[str], key: str = "acct_id"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Roots without repeated keys, children below an existing root, and orphans.

    Of rows with the same key the smallest one is kept, whatever the file order.
    """
    def unique(df: DataFrame, keys: list[str]) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
        return kept.select(*[c if c in keys else F.col(f"_row.{c}") for c in df.columns])

    known = unique(roots, [key])
    rows = unique(
        children.withColumnRenamed("root_key", key) if "root_key" in children.columns else children,
        [key, *child_key],
    )
    root_keys = known.select(key)
    return known, rows.join(root_keys, key, "left_semi"), rows.join(root_keys, key, "left_anti")
