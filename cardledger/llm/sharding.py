"""Shards by vector bin packing: bytes, tokens and rows are balanced together.

Equal texts form a group and go to one shard.  A group is placed where the dot product of its size
vector with the shard's residual capacity is highest.  The few groups that matter for balance (their
number is bounded by the number of shards) are packed first, largest first, in one task; all others
are dealt to parts of equal expected size, and each part packs its own groups into its share of the
capacity that is left.  Only a group larger than a shard's fair share is split: its rows are numbered
and dealt by their number, so repeated or null ids are dealt like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardledger.llm.common import store, tasks

SHARDS = 24
#: A unit above this share of a shard, in any dimension, is packed first: at most 3 x 256 x shards.
LARGE = 1 / 256
#: Expected units of a part that is packed by itself.
PART_UNITS = 50_000
_DIMS = ["b", "t", "r"]
#: Weight of each dimension in the dot product: the law promises equal bytes.
_WEIGHTS = np.array([16.0, 1.0, 1.0])


def pack(sizes: np.ndarray, residual: np.ndarray, turn: int = 0) -> np.ndarray:
    """Shard of each unit, in the given order; ``residual`` (shards x dimensions) is used up.

    Sizes and capacities are shares of a shard.  Among equals the first shard from ``turn`` on wins.
    """
    n = len(residual)
    order = np.roll(np.arange(n), -(turn % n))
    room = residual[order].copy()
    chosen = np.empty(len(sizes), dtype=np.int32)
    for at, unit in enumerate(sizes):
        best = int(np.argmax(room @ (unit * _WEIGHTS)))
        room[best] -= unit
        chosen[at] = best
    residual[order] = room
    return order[chosen].astype(np.int32) if len(sizes) else chosen


def _vectors(frame: pd.DataFrame, fair: list[float]) -> np.ndarray:
    return frame[_DIMS].to_numpy(dtype=float) / np.array(fair)


def _largest_first(frame: pd.DataFrame, fair: list[float]) -> pd.DataFrame:
    key = _vectors(frame, fair).max(axis=1)
    return frame.assign(__k=-key).sort_values(["__k", "digest", "chunk"]).drop(columns="__k")


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``number`` to the rows of split groups (those with ``chunks``): 0, 1, ... in each group.

    A row's number is its place among its group's rows of the same stored part, plus the group's rows
    in the parts before; a part is what one task wrote, so no window grows with a group.
    """
    split = rows.where(F.col("chunks").isNotNull()).withColumn("part", F.shiftright("pos", 33))
    place = F.row_number().over(Window.partitionBy("digest", "part").orderBy("pos")) - 1
    counts = split.groupBy("digest", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("digest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("digest", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    numbered = split.withColumn("place", place).join(shift, ["digest", "part"])
    numbered = numbered.withColumn("number", F.col("place") + F.col("shift")).drop("part", "place", "shift")
    return rows.where(F.col("chunks").isNull()).withColumn("number", F.lit(0).cast("bigint")).unionByName(numbered)


def vector_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and gapless slot of every document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  Returns one row per input
    row: ``doc_id``, ``size`` (UTF-8 bytes + 8), ``text_crc32``, ``law`` ('bytes'), ``shard``,
    ``slot`` and ``grown_shard`` (null: the law does not place by key).  A null text is empty; empty
    texts are one group like any other equal texts, and repeated rows keep a slot each.  Null and
    repeated ids are no key to anything: a large group that shares one id is split by row numbers like any
    other.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = store(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + 8).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit(r"\S+")).cast("bigint").alias("tokens"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("pos"),
        ),
        "sizes",
    )
    sums = [F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")]
    total = rows.agg(*sums).first()
    fair = [max(1.0, float(x or 0) / shards) for x in total]
    share = F.greatest(*[F.col(d) / f for d, f in zip(_DIMS, fair, strict=True)])

    # Groups above a fair share: fewer than shards x dimensions.
    split = rows.groupBy("digest").agg(*sums).where(share > 1)
    split = split.select("digest", F.ceil(2 * share).alias("chunks"))
    rows = _numbered(rows.join(F.broadcast(split), "digest", "left"))
    rows = rows.withColumn("chunk", F.coalesce(F.pmod("number", "chunks"), F.lit(0))).drop("chunks", "pos")
    units = store(rows.groupBy("digest", "chunk").agg(*sums), "units")

    n_units = units.count()
    large = _largest_first(units.where(share > LARGE).toPandas(), fair)
    residual = np.ones((shards, len(_DIMS)))
    placed = large[["digest", "chunk"]].assign(shard=pack(_vectors(large, fair), residual))
    parts = max(1, -(-n_units // PART_UNITS))
    rest = residual.clip(min=0)
    rest = (rest / rest.sum(axis=0).clip(min=1e-12)).tolist()

    def pack_part(frame: pd.DataFrame) -> pd.DataFrame:
        frame = _largest_first(frame, fair)
        sizes = _vectors(frame, fair)
        room = np.array(rest) * sizes.sum(axis=0)
        turn = int(frame["part"].iloc[0])
        return frame[["digest", "chunk"]].assign(shard=pack(sizes, room, turn))

    schema = "digest binary, chunk bigint, shard int"
    small = units.where(share <= LARGE).withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(parts)))
    shard_of = small.groupBy("part").applyInPandas(pack_part, schema)
    first = spark.createDataFrame(placed, schema) if len(placed) else spark.createDataFrame([], schema)
    shard_of = store(shard_of.unionByName(first), "placed")

    # Slots: a shard's rows are numbered per piece, and the pieces one after the other.
    pieces = tasks(spark)
    piece = F.pmod(F.xxhash64("doc_id", "text_crc32", "number"), F.lit(pieces)).cast("int")
    dealt = rows.join(shard_of, ["digest", "chunk"]).withColumn("piece", piece)
    dealt = store(dealt.select("doc_id", "size", "text_crc32", "shard", "piece"), "dealt")
    counts = dealt.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    own = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("doc_id", "size", "text_crc32"))
    return dealt.withColumn("own", own - 1).join(shift, ["shard", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("own") + F.col("shift")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
