"""Line deduplication by content-defined chunks.

A rolling hash over the hashes of the last three lines says whether a chunk ends with a line, so
boundaries move along when lines are put in before them.  Chunks of several lines that occur again
anywhere are removed, all but their first occurrence.  A cheap first pass counts 64-bit hashes of
chunks; only chunks with a repeated hash send their bytes, and these are grouped by the bytes
themselves.  Equal chunks combine before the shuffle, and the join that tells later occurrences from
the first can be split where one chunk is very common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import store

ROLL = 3
#: A chunk ends where the rolling hash begins with one of these: one line in four.
ENDS = ["0", "1", "2", "3"]
_NONE = "array<int>"


def _with_chunks(docs: DataFrame, text: Column, *keep: Column | str) -> DataFrame:
    """``keep`` and ``lines``, ``firsts`` and ``lasts`` (line numbers of the chunks)."""
    df = docs.select(*keep, F.split(text, "\n").alias("lines"))
    df = df.withColumn("hashes", F.transform("lines", lambda x: F.md5(x.cast("binary"))))
    n = F.size("hashes")

    def ends(i: Column) -> Column:
        rolled = F.concat(*[F.coalesce(F.get("hashes", i - j), F.lit("")) for j in range(ROLL - 1, -1, -1)])
        return F.substring(F.md5(rolled.cast("binary")), 1, 1).isin(ENDS)

    cuts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i < n - 1) & ends(i))
    df = df.select(*[c for c in df.columns if c != "hashes"], cuts.alias("cuts"))
    return df.select(
        *[c for c in df.columns if c != "cuts"],
        F.concat(F.array(F.lit(0)), F.transform("cuts", lambda i: i + 1)).alias("firsts"),
        F.concat(F.col("cuts"), F.array(F.size("lines") - 1)).alias("lasts"),
    )


def _chunk(k: Column) -> Column:
    first, last = F.get("firsts", k), F.get("lasts", k)
    return F.array_join(F.slice("lines", first + 1, last - first + 1), "\n")


def line_dedup(docs: DataFrame) -> DataFrame:
    """Texts without the multi-line chunks that occurred before.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  Returns one row per input
    row: ``doc_id``, ``text`` (what is left, chunks joined by line ends), ``n_lines``, ``n_chunks``,
    ``n_removed`` (chunks), ``n_removed_lines``.  The first occurrence is the one with the smallest
    (``doc_id``, chunk number), a null id first.  Single-line chunks stay.  A null text counts as
    empty, which is one empty line; a text whose chunks all go becomes empty.  Rows that repeat an
    id and a text are one occurrence and get equal results.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark")]
    own = _with_chunks(docs, text, *key)
    several = F.filter(
        F.sequence(F.lit(0), F.size("firsts") - 1), lambda k: F.get("lasts", k) > F.get("firsts", k)
    )
    chunks = own.select(
        "doc_id", "mark",
        F.explode(F.transform(several, lambda k: F.struct(k.alias("k"), _chunk(k).alias("chunk")))).alias("c"),
    ).select("doc_id", "mark", "c.*").withColumn("hash", F.xxhash64("chunk"))
    again = chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    chunks = store(chunks.join(store(again, "again"), "hash"), "chunks")

    # Bytes decide: grouped and joined by the chunk itself.
    first = chunks.groupBy("hash", "chunk").agg(F.min(F.struct("doc_id", "k")).alias("first"))
    later = chunks.join(store(first, "first"), ["hash", "chunk"])
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k") == F.col("first.k"))
    gone = later.where(~stays).groupBy("doc_id", "mark").agg(F.collect_set("k").alias("gone"))
    gone = store(gone, "gone").alias("g")

    every = docs.select(*key, text.alias("text")).alias("e")
    same = every["doc_id"].eqNullSafe(gone["doc_id"]) & (every["mark"] == gone["mark"])
    none = F.array().cast(_NONE)
    # Sorted on both sides at every size: a broadcast of small lists would not grow with the input.
    every = every.join(gone.hint("merge"), same, "left").select(
        "e.doc_id", "e.text", F.coalesce("g.gone", none).alias("gone")
    )
    cut = _with_chunks(every, F.col("text"), "doc_id", "gone")
    stay = F.filter(
        F.sequence(F.lit(0), F.size("firsts") - 1), lambda k: ~F.array_contains("gone", k)
    )
    removed = F.transform("gone", lambda k: F.get("lasts", k) - F.get("firsts", k) + 1)
    return cut.select(
        "doc_id",
        F.array_join(F.transform(stay, _chunk), "\n").alias("text"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("firsts").cast("bigint").alias("n_chunks"),
        F.size("gone").cast("bigint").alias("n_removed"),
        F.aggregate(removed, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_removed_lines"),
    )
