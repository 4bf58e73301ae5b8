"""Benchmark decontamination by winnowing.

Of every run of consecutive k-gram hashes the least is kept as a fingerprint, on both sides.  A run
is as long as a shared window, so any shared window brings the same fingerprint on both sides.  The
documents' fingerprints meet the benchmark's in an equi-join; a hit is then extended to the windows
around it, and a window counts only if its words are equal.  Items shorter than a window are one
window, looked up as a gram of their own length.

Benchmark tables are stored first, so Spark knows their size when it chooses between a broadcast and
a shuffle.  Documents are read again only to extend hits, not to carry their words through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import store, words

WINDOW = 10
GRAM = 5


def _grams(hashes: Column, k: int, tag: int) -> Column:
    """Hash of each run of k word hashes; the tag keeps lengths apart."""
    last = F.size(hashes) - k
    each = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(F.lit(tag), *[F.get(hashes, i + j) for j in range(k)]),
    )
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def _winnowed(grams: Column, run: int) -> Column:
    """Least of each ``run`` consecutive hashes, each value once."""
    last = F.size(grams) - run
    least = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.least(*[F.get(grams, i + j) for j in range(run)])
    )
    return F.array_distinct(F.when(last >= 0, least).otherwise(F.array().cast("array<bigint>")))


def _hashed(df: DataFrame, text: Column, *keep: str | Column) -> DataFrame:
    """``keep`` and the columns ``ws`` (words), ``hs`` (their hashes) and ``gs`` (gram hashes)."""
    df = df.select(*keep, words(text).alias("ws"))
    df = df.withColumn("hs", F.transform("ws", lambda w: F.xxhash64(w)))
    return df.withColumn("gs", _grams(F.col("hs"), GRAM, 0))


def _span(ws: Column, start: Column, length: int) -> Column:
    text = F.array_join(F.slice(ws, start + 1, length), " ")
    return F.struct(start.alias("start"), F.lit(length).alias("length"), text.alias("span"))


def _spans(ws: Column, starts: Column, length: int) -> Column:
    return F.transform(starts, lambda s: _span(ws, s, length))


def _short_starts(ws: Column, grams: Column, length: int) -> Column:
    """Where a gram of a short item's length is among the met fingerprints."""
    there = F.filter(_all_starts(ws, length), lambda i: F.array_contains("met", F.get(grams, i)))
    return F.when(F.size(ws) >= length, there).otherwise(F.array().cast("array<int>"))


def _all_starts(ws: Column, length: int) -> Column:
    return F.sequence(F.lit(0), F.size(ws) - length)


def _covered(spans: Column) -> Column:
    """Number of places that sorted (start, length) spans cover together."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(acc["end"], x["start"])))
            .cast("bigint").alias("n"),
            F.greatest(acc["end"], x["start"] + x["length"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Which words of every document stand in a window of a benchmark item.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` needs ``item_id`` and ``text``; other
    columns are not read.  A window is ``window`` consecutive item words; an item of fewer, but not
    none, is one window.  Returns one row per input row: ``doc_id``, ``n_words``, ``n_hit``,
    ``n_items``, ``item_ids`` (as strings, sorted), ``contaminated``.  Null or empty texts have no
    words and match nothing; rows that repeat an id and a text get equal results; an item without an
    id marks words but is in no list; an empty benchmark leaves all documents clean.
    """
    run = window - GRAM + 1
    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark")]
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["mark"] == b["mark"])

    items = _hashed(benchmark, F.col("text"), F.col("item_id").cast("string").alias("item_id"))
    items = store(items.where(F.size("ws") > 0), "items")
    n = F.size("ws")
    short = [r[0] for r in items.where(n < window).select(n).distinct().collect()]  # below window
    whole = items.where(n >= window)
    spans = whole.select(
        "item_id", F.explode(_spans(F.col("ws"), _all_starts(F.col("ws"), window), window))
    )
    prints = whole.select(F.explode(_winnowed(F.col("gs"), run)).alias("print"))
    for m in short:
        own = items.where(n == m)
        spans = spans.unionByName(own.select("item_id", _span(F.col("ws"), F.lit(0), m).alias("col")))
        prints = prints.unionByName(own.select(F.explode(_grams(F.col("hs"), m, m)).alias("print")))
    spans = store(spans.select("item_id", "col.span").distinct(), "spans")
    prints = store(prints.distinct(), "prints")

    # Fingerprints of the documents against those of the benchmark.
    own = _hashed(docs, F.col("text"), *key)
    found = F.array_distinct(F.concat(_winnowed(F.col("gs"), run), *[_grams(F.col("hs"), m, m) for m in short]))
    met = own.select("doc_id", "mark", F.explode(found).alias("print")).join(prints, "print")
    met = met.groupBy("doc_id", "mark").agg(F.collect_set("print").alias("met"))
    met = store(met, "met")

    # Hits extended: every window that holds a met gram, with its words.
    left = docs.select(*key, "text").alias("d")
    right = met.alias("m")
    back = left.join(right, same(left, right)).select("d.doc_id", "d.mark", "d.text", "m.met").distinct()
    back = _hashed(back, F.col("text"), "doc_id", "mark", "met")
    ws, gs, hs = F.col("ws"), F.col("gs"), F.col("hs")
    at = F.filter(F.sequence(F.lit(0), F.size(gs) - 1), lambda i: F.array_contains("met", F.get(gs, i)))
    around = F.flatten(
        F.transform(
            at, lambda i: F.sequence(F.greatest(F.lit(0), i - (window - GRAM)), F.least(i, F.size(ws) - window))
        )
    )
    back = back.withColumn(
        "starts", F.when(F.size(ws) >= window, F.array_distinct(around)).otherwise(F.array().cast("array<int>"))
    )
    tried = [_spans(ws, F.col("starts"), window)]
    tried += [_spans(ws, _short_starts(ws, _grams(hs, m, m), m), m) for m in short]
    tried = back.select("doc_id", "mark", F.explode(F.concat(*tried)).alias("x"))
    tried = tried.select("doc_id", "mark", "x.*").join(spans, "span")
    hits = tried.groupBy("doc_id", "mark").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )
    hits = store(hits.select("doc_id", "mark", _covered(F.col("spans")).alias("n_hit"), "item_ids"), "hits")

    # Words are counted without making them.
    count = F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint")
    every = docs.select(*key, count.alias("n_words")).alias("e")
    hit = hits.alias("h")
    n_hit = F.coalesce("h.n_hit", F.lit(0).cast("bigint"))
    ids = F.coalesce("h.item_ids", F.array().cast("array<string>"))
    return every.join(hit, same(every, hit), "left").select(
        "e.doc_id", "e.n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"),
        ids.alias("item_ids"), (n_hit > 0).alias("contaminated"),
    )
