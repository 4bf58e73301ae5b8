"""Quality by compression: which of two zstandard dictionaries packs a text better.

One dictionary is trained on good and one on bad labelled text.  A text is cut into blocks, each block
is compressed with both, and the sizes are summed, so a long text leans on the dictionaries as much
as a short one.  The difference of the sizes over their sum, with the compression ratio and both
squared, goes through a logistic curve fitted on labelled texts that the dictionaries have not seen, weighted to the labels'
true shares.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.sample import held_out, sample_by

#: Labelled documents a class to learn from, and the longest text among them, in characters.
SAMPLE = 2_000
SAMPLE_CHARS = 20_000
DICTIONARY = 112 * 1024
BLOCK = 2_048
LEVEL = 3
CUT = 0.3
#: Fewest blocks a dictionary is trained on; below, the blocks themselves are the dictionary.
_TRAINABLE = 200


def _blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


def _dictionary(texts: list[bytes]) -> bytes:
    blocks = [b for t in texts for b in _blocks(t) if len(b) >= 8]
    if len(blocks) >= _TRAINABLE:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    return b"".join(blocks)[:DICTIONARY]


@dataclass
class Compressors:
    """Features of a text from its sizes under both dictionaries."""

    good: bytes
    bad: bytes

    def open(self) -> Callable[[bytes], list[float]]:
        packers = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False
            )
            for d in (self.good, self.bad)
        ]

        def features(text: bytes) -> list[float]:
            blocks = _blocks(text)
            good, bad = (sum(len(p.compress(b)) for b in blocks) for p in packers)
            apart = 20 * (bad - good) / max(1, bad + good)
            packed = float(np.log((1 + good) / (1 + len(text))))
            return [1.0, apart, apart * apart, packed, packed * packed, float(np.log1p(len(text))) / 10]

        return features


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    beta, ridge = np.zeros(x.shape[1]), 1e-3 * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        beta = beta + np.clip(np.linalg.solve(bend, slope), -5, 5)
    return beta


@dataclass
class Model:
    compressors: Compressors | None
    beta: np.ndarray
    share: float


def fit(rows: list[tuple[int, str]], counts: dict[int, int]) -> Model:
    """Fit to (label, text) rows; without both labels the score is the share of label 1, or 0.5."""
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    texts = {k: [t.encode() for label, t in rows if label == k] for k in (0, 1)}
    if min(len(texts[0]), len(texts[1])) < 2:
        return Model(None, np.zeros(0), share)
    compressors = Compressors(_dictionary(texts[1][::2]), _dictionary(texts[0][::2]))
    features = compressors.open()
    x, y, w = [], [], []
    for label in (0, 1):
        unseen = texts[label][1::2]
        x += [features(t) for t in unseen]
        y += [label] * len(unseen)
        w += [counts[label] / len(unseen)] * len(unseen)
    weight = np.array(w) / sum(w) * len(w)
    return Model(compressors, _logistic(np.array(x), np.array(y, float), weight), share)


def _scorer(model: Model) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = model.compressors.open()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            x = np.array([features(t or b"") for t in texts]).reshape(len(texts), len(model.beta))
            p = 1 / (1 + np.exp(-np.clip(x @ model.beta, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    return score


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Quality score of every document.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` needs ``doc_id`` and ``quality`` (0 or 1, else
    ignored); other columns are not read.  Only labelled rows that are not held out are learned
    from.  Returns one row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted``
    (1 from 0.3 on).  A null text counts as empty, and an empty text gets the score of its features
    like any other; if one label is missing, all scores are the share of label 1 (0.5 without
    labels).  Repeated rows get equal results.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
    marks = marks.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    drawn, counts = sample_by(marks, "quality", sample, SAMPLE_CHARS, rows)
    model = fit(drawn, counts)
    if model.compressors is None:
        found = rows.select("doc_id", F.lit(float(model.share)).alias("score"))
    else:
        found = rows.mapInArrow(_scorer(model), "doc_id bigint, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
