"""A corpus from documents: language, exact copies, near copies, benchmark leaks, piece ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), decides by one of the
text operators on all that its predecessor kept, and all but the last return the columns of
``docs``.  Between stages the documents are written as Parquet and read again.  Stages decide on
ids: rows that share an id stay or go together (a null id is an id like any other).  In the copy and
language stages an id goes if all of its rows would, in the benchmark stage if any of them does.

All stages run in the same executors, whose memory keeps what the largest took, so each of them asks for small
batches of texts first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardledger.llm.common import small_batches, store, table
from cardledger.llm.decontaminate import decontaminate
from cardledger.llm.exact import exact_dedup
from cardledger.llm.language import UNKNOWN, identify
from cardledger.llm.pieces import piece_tokens
from cardledger.llm.simhash import simhash_components

#: Least share of a document's features met in learning; below, it is in none of the learned languages.
#: On sf0.1 no document with a letter is below 0.91.  With a language left out of learning, 98 to 100 in
#: a hundred of its documents go; of English, the largest, only 7, since the other three share its letters.
MIN_KNOWN = 0.9

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(work: Stage) -> Stage:
    """A stage that has few texts in memory at a time."""

    @wraps(work)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return work(spark, docs, sf_dir)

    return begin


def _without(docs: DataFrame, decided: DataFrame, reject: Column, every: bool = True) -> DataFrame:
    """Documents but for the rejected ids.  These are stored first, so that Spark knows their size
    when it chooses how to join."""
    gone = decided.groupBy("doc_id").agg((F.every(reject) if every else F.some(reject)).alias("gone"))
    gone = store(gone.where("gone").select("doc_id"), "rejected")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those that fit no learned language."""
    found = identify(docs)
    return _without(docs, found, (F.col("lang_pred") == UNKNOWN) | (F.col("known") < MIN_KNOWN))


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return _without(docs, exact_dedup(docs), ~F.col("kept"))


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near copies."""
    found = simhash_components(docs)
    return _without(docs, found, ~F.col("doc_id").eqNullSafe(F.col("component_id")))


@_stage
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a window of a benchmark item."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found, F.col("contaminated"), every=False)


@_stage
def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left."""
    return piece_tokens(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("benchmark_decontamination", benchmark),
    ("sentencepiece", pieces),
]

#: The language model, the fingerprints and the pieces have no SQL form; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
