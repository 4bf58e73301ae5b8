"""Connected components by alternating large-star and small-star steps, each written to storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them and the node: the larger ones
    (``large``) or the smaller ones and the node itself."""
    both = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    near = both.join(least, "u")
    if large:
        out = near.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = near.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
        out = out.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.where("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node reachable) of every node of ``edges`` (a, b: not null).

    Self links and repeated links do no harm; no edges give no rows.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = store(edges.where("a < b").distinct(), "edges")
    mark = [F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(2**31)))]
    last = None
    while (now := edges.agg(*mark).first()) != last:
        last = now
        edges = store(_star(store(_star(edges, True), "edges"), False), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
