"""Ordered fold under a shrinking headroom: posting against a limit, authorization decisions.

Within one key, rows are taken in order.  A row is accepted when it is eligible and its ``gate``
does not exceed the headroom at that moment; an accepted row takes its ``weight`` off the
headroom, a refused one changes nothing.  A running sum cannot express this, since refused rows
do not count.

Two exact ways are used:

* Ordinary keys: rows are shuffled by key and sorted by (key, order), and a task reads them as a
  stream of Arrow batches, keeping one number.  Up to a key's first refusal a batch is decided by
  prefix sums, and only the rows behind it one by one.  No group is ever collected.  (The same fold with
  the built-in ``aggregate`` over collected arrays took twice as long for small keys, and more
  for larger ones.)
* Hot keys, above ``hot_rows``, may hold a large part of all rows, too many for one task.  Their
  rows are range-partitioned on (key, order) and cut into chunks of bounded size.

What a chunk does to the headroom is a function that takes off one amount on each of a few
stretches: which rows are accepted changes only where the headroom meets a gate exactly.  Every chunk is
turned into its function, ``FAN`` neighbours at a time are merged into the function of them
all, level by level, until a key has at most ``FAN`` left.  Going down again, each level learns its
opening headrooms from the level above by looking values up, and at the bottom all chunks are
decided independently.  Each level is one grouped step over all chunks, so the number of steps grows
with the logarithm of the rows, and amounts of both signs are nothing special.

A function is kept only for headrooms that can occur before its first row.  The bounds are running sums
and maxima over the chunks: an account below its limit has one possible headroom, one that
meets its limit has those below about its largest gates, however many rows it has.  A function has no more
stretches than whole amounts in that range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger.session import materialize

HOT_ROWS = 1_000_000
#: Rows of a hot key that one function covers, and functions that are merged into one.
CHUNK_ROWS = 1_024
FAN = 32
#: Rows that a task of the range partitioning gets.
ROWS_PER_TASK = 524_288


def fold_in_order(
    df: DataFrame,
    key: str,
    order: list[str],
    source: DataFrame | None = None,
    key_counts: Callable[[], DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``accepted`` to ``df``.

    ``df`` carries ``gate``, ``weight``, ``start`` (bigint, ``start`` constant within a key) and
    ``eligible`` (boolean), none of them null.  (key, order) is unique and not null.

    Whether there are hot keys is settled by counting: first the rows of ``source`` (the scan
    that ``df`` has a row each of, if given), which is a matter of file footers, and only when
    they exceed ``hot_rows`` the rows per key (``key_counts`` gives them as ``n``, if the caller
    has a cheap form of it).
    """
    if (df if source is None else source).count() <= hot_rows:
        return _fold_sorted(df, key, order)
    counts = df.groupBy(key).agg(F.count("*").alias("n")) if key_counts is None else key_counts()
    hot = counts.where(F.col("n") > hot_rows).select(key, "n")
    if hot.isEmpty():
        return _fold_sorted(df, key, order)
    hot = materialize(hot, "hot-keys")
    keys = hot.select(key)
    cold = _fold_sorted(df.join(keys, key, "left_anti"), key, order)
    hot_df = df.join(keys, key, "left_semi")
    total = hot.agg(F.sum("n")).first()[0]
    decided = _fold_chunks(hot_df, key, order, total, chunk_rows)
    return cold.unionByName(
        hot_df.join(decided, [key, *order], "inner").select(*cold.columns)
    )


def _fold_sorted(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Read each partition in (key, order) order, carrying the headroom of the current key."""
    schema = T.StructType([*df.schema, T.StructField("accepted", T.BooleanType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, room = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            flags, room = _walk_batch(keys, current, room, *(_numbers(batch.column(c)) for c in _FOLDED))
            current = keys[-1]
            yield batch.append_column("accepted", pa.array(flags))

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(walk, schema)


_FOLDED = ("gate", "weight", "start", "eligible")


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _walk_batch(
    keys: pa.Array, current: pa.Scalar | None, room: int,
    gate: np.ndarray, weight: np.ndarray, start: np.ndarray, eligible: np.ndarray,
) -> tuple[np.ndarray, int]:
    """Decisions of a batch sorted by (key, order), and the headroom behind its last row.

    ``room`` is what ``current``, the last key before, has left.  Up to a key's first refusal the
    headroom is a running sum; only what follows is taken row by row.
    """
    change = np.asarray(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False), dtype=bool)
    begins = np.concatenate(([0], np.flatnonzero(change) + 1))
    ends = np.concatenate((begins[1:], [len(gate)]))
    opening = start[begins].copy()
    if current is not None and keys[0] == current:
        opening[0] = room
    taken = np.where(eligible, weight, 0)
    before = taken.cumsum() - taken
    left = np.repeat(opening + before[begins], ends - begins) - before
    refused = eligible & (gate > left)
    first = np.minimum.reduceat(np.where(refused, np.arange(len(gate)), len(gate)), begins)
    flags = eligible.copy()
    room = int(left[-1] - taken[-1])
    for at, end in zip(first[first < ends].tolist(), ends[first < ends].tolist()):
        rest = slice(at, end)
        flags[rest], after = _walk(gate[rest].tolist(), weight[rest].tolist(), eligible[rest].tolist(), int(left[at]))
        if end == len(gate):
            room = after
    return flags, room


def walk_keys(
    keys: np.ndarray, start: np.ndarray, gate: np.ndarray, weight: np.ndarray, eligible: np.ndarray
) -> np.ndarray:
    """Decisions of rows sorted by (key, order); ``start`` is the headroom before a key's first row."""
    return _walk_batch(pa.array(keys), None, 0, gate, weight, start, eligible)[0]


# --- hot keys -------------------------------------------------------------------------------


@dataclass
class Step:
    """What some rows do to a headroom: from ``at[i]`` up to the next ``at`` they take ``drop[i]`` off.

    ``at`` rises and begins with the least headroom the function is asked for.
    """

    at: np.ndarray
    drop: np.ndarray

    def __call__(self, room: int) -> int:
        return int(room - self.drop[max(0, np.searchsorted(self.at, room, "right") - 1)])

    def then(self, other: Step, top: int) -> Step:
        """This function and then the other one, for headrooms up to ``top``."""
        low = self.at - self.drop
        ends = np.append(self.at[1:], top + 1) - 1 - self.drop
        first = np.maximum(np.searchsorted(other.at, low, "right") - 1, 0)
        last = np.maximum(np.searchsorted(other.at, ends, "right") - 1, 0)
        counts = last - first + 1
        own = np.repeat(np.arange(len(counts)), counts)
        theirs = np.arange(len(own)) - np.repeat(counts.cumsum() - counts, counts) + first[own]
        at = np.maximum(self.at[own], other.at[theirs] + self.drop[own])
        return Step(at, self.drop[own] + other.drop[theirs])._merged()

    def _merged(self) -> Step:
        keep = np.concatenate(([True], self.drop[1:] != self.drop[:-1]))
        return Step(self.at[keep], self.drop[keep])

    @staticmethod
    def of_rows(gate: np.ndarray, weight: np.ndarray, low: int, top: int) -> Step:
        """The function of eligible rows in order, for headrooms from ``low`` to ``top``."""
        # Stretches are kept in the order they arise; what each begins with, what is left of that,
        # and how far it reaches.
        kept = np.array([[low], [low], [top + 1 - low]], dtype=np.int64)
        n = 1
        for g, w in zip(gate.tolist(), weight.tolist()):
            at, room, size = kept[:, :n]
            # A stretch that holds the gate inside is cut there.
            cut = np.flatnonzero((room < g) & (room + size > g))
            if len(cut):
                more = n + len(cut)
                if more > kept.shape[1]:
                    kept = np.concatenate([kept, np.zeros((3, 2 * more), dtype=np.int64)], axis=1)
                    at, room, size = kept[:, :n]
                lower = g - room[cut]
                kept[:, n:more] = at[cut] + lower, np.full(len(cut), g), size[cut] - lower
                size[cut] = lower
                n, room = more, kept[1, :more]
            np.subtract(room, w, out=room, where=room >= g)
        order = kept[0, :n].argsort()
        at, room = kept[0, :n][order], kept[1, :n][order]
        return Step(at, at - room)._merged()


def _walk(gate: list, weight: list, eligible: list, room: int) -> tuple[list[bool], int]:
    flags = []
    for g, w, e in zip(gate, weight, eligible):
        ok = bool(e) and g <= room
        if ok:
            room -= w
        flags.append(ok)
    return flags, room


def _fold_chunks(
    df: DataFrame, key: str, order: list[str], total: int, chunk_rows: int
) -> DataFrame:
    """Decisions (key, order, accepted) of hot keys."""
    spark = df.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_TASK))
    narrow = df.select(key, *order, "gate", "weight", "start", "eligible")
    placed = narrow.repartitionByRange(partitions, key, *order).sortWithinPartitions(key, *order)
    # The position follows the sort just made and is stored before anything else uses it.
    placed = placed.withColumn("pos", F.monotonically_increasing_id())
    rows = materialize(placed.withColumn("chunk", F.floor(F.col("pos") / chunk_rows)), "hot-rows")

    # Chunks of a key get dense numbers and the range of headrooms that can meet them.  If a row is
    # refused, what is left at the end is below the last refused gate less all weights behind it, else
    # it is what was there less all weights.  At least it is what an accepted row left, or what was
    # there if that is less, and never less than with all debits taken off.
    own = rows.where(F.col("eligible") & (F.col("weight") != 0))
    taken = F.sum("weight").over(Window.partitionBy(key, "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    weight = F.col("weight")
    sizes = own.withColumn("refused", F.col("gate") - 1 + taken).groupBy(key, "chunk").agg(
        F.sum("weight").alias("net"), F.sum(F.when(weight > 0, weight).otherwise(0)).alias("debit"),
        F.min(F.when(weight > 0, F.col("gate") - weight)).alias("floor"), F.max("refused").alias("refused"),
    )
    sizes = rows.groupBy(key, "chunk").agg(F.first("start").alias("start")).join(sizes, [key, "chunk"], "left")
    along = Window.partitionBy(key).orderBy("chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    so_far = {c: F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("net", "debit")}
    sizes = sizes.withColumns({"net_before": so_far["net"], "debit_before": so_far["debit"]})
    highest = F.coalesce(F.max(F.col("refused") + F.col("net_before")).over(before), F.col("start"))
    top = F.greatest("start", highest) - F.col("net_before")
    least = F.least("start", F.coalesce(F.min("floor").over(before), F.col("start")))
    low = F.greatest(least, F.col("start") - F.col("debit_before"))
    ranges = materialize(
        sizes.select(key, "chunk", "start", (F.row_number().over(along) - 1).cast("bigint").alias("no"),
                     low.alias("low"), top.alias("top")),
        "chunk-ranges",
    )

    key_field = T.StructField(key, df.schema[key].dataType)
    longs, whole = T.ArrayType(T.LongType()), T.LongType()

    def schema(**fields: T.DataType) -> T.StructType:
        return T.StructType([key_field, *[T.StructField(n, t) for n, t in fields.items()]])

    def function(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf.iloc[0]
        own = pdf[pdf["eligible"] & (pdf["weight"] != 0)].sort_values("pos")
        step = Step.of_rows(own["gate"].to_numpy(), own["weight"].to_numpy(), int(head["low"]), int(head["top"]))
        return pd.DataFrame({key: [group[0]], "no": [head["no"]], "top": [head["top"]], "at": [step.at], "drop": [step.drop]})

    def merge(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        top = int(pdf["top"].iloc[0])
        step = reduce(lambda a, b: a.then(b, top), [Step(a, d) for a, d in zip(pdf["at"], pdf["drop"])])
        return pd.DataFrame({key: [group[0]], "no": [group[1]], "top": [top], "at": [step.at], "drop": [step.drop]})

    def openings(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        rooms, room = [], int(pdf["opening"].iloc[0])
        for at, drop in zip(pdf["at"], pdf["drop"]):
            rooms.append(room)
            room = Step(at, drop)(room)
        return pd.DataFrame({key: group[0], "no": pdf["no"], "opening": rooms})

    kept = schema(no=whole, top=whole, at=longs, drop=longs)
    joined = rows.join(ranges.drop("start"), [key, "chunk"])
    levels = [materialize(joined.groupBy(key, "chunk").applyInPandas(function, kept), "functions")]
    groups = ranges.groupBy(key).agg(F.max("no")).agg(F.max("max(no)")).first()[0] + 1
    while groups > FAN:
        parent = F.floor(F.col("no") / FAN).alias("parent")
        levels.append(materialize(levels[-1].groupBy(key, parent).applyInPandas(merge, kept), "functions"))
        groups = -(-groups // FAN)

    known = ranges.where("no = 0").select(key, F.lit(0).cast("bigint").alias("parent"), F.col("start").alias("opening"))
    for place, level in reversed(list(enumerate(levels))):
        children = level.withColumn("parent", F.lit(0).cast("bigint") if level is levels[-1] else F.floor(F.col("no") / FAN))
        found = children.join(known, [key, "parent"]).groupBy(key, "parent").applyInPandas(openings, schema(no=whole, opening=whole))
        known = materialize(found.withColumnRenamed("no", "parent") if place else found, "openings")

    def decide(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        flags, _ = _walk(pdf["gate"].tolist(), pdf["weight"].tolist(), pdf["eligible"].tolist(), int(pdf["opening"].iloc[0]))
        return pdf[[key, *order]].assign(accepted=flags)

    out_schema = T.StructType([*[narrow.schema[c] for c in [key, *order]], T.StructField("accepted", T.BooleanType())])
    opened = ranges.select(key, "chunk", "no").join(known, [key, "no"]).drop("no")
    return rows.join(opened, [key, "chunk"]).groupBy(key, "chunk").applyInPandas(decide, out_schema)
