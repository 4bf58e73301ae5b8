"""Language of words and documents by a linear-chain conditional random field.

A word's features are the letter pairs and triples of the word with its ends marked (so affixes of
one and two letters too), affixes of three letters, and the lexicons of frequent words of each
language.  Transitions between neighbouring words are learned from lines into which stretches of
other languages were spliced, and forward-backward gives each word's probabilities.  A document's
language is the one with the greatest mean over its words.

These probabilities compare the learned languages with each other, so they are high for text in none
of them too.  ``known`` tells that: the share of a document's features that were met in learning,
allowing for as many new ones as text of the learned languages brings (by Good and Turing's
estimate, the share of the sample's features that were met once).

The model is fitted on the driver from a bounded sample (``SAMPLE`` documents a language).  Each task
labels the lines of a batch together, one step for the t-th word of all lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.sample import held_out, sample_by

#: Documents a language to learn from, and the longest text among them, in characters.
SAMPLE = 150
SAMPLE_CHARS = 20_000
LEXICON = 300
TABLE = 1 << 16
UNKNOWN = "und"
#: Features taken as met beside a document's own in ``known``, so that one odd word is no verdict.
_GIVEN = 50
#: Words labelled together, and words whose scores a task remembers.
_CHUNK, _CACHE = 100_000, 200_000
_TOKENS = re.compile(r"[^\W\d_]+|\n")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def feature_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs of all words, in word order."""
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    text = "".join(f"\x02{w}\x03" for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    owners, ids = [], []
    for n in (2, 3, 4):
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ points[k : len(points) - n + 1 + k]) * _MIX
            h ^= h >> np.uint64(29)
        inside = word[: len(h)] == word[n - 1 :]
        if n == 4:  # affixes only
            inside &= (points[: len(h)] == 2) | (points[n - 1 :] == 3)
        owners.append(word[: len(h)][inside])
        ids.append((h[inside] % np.uint64(TABLE)).astype(np.int64))
    owner, feature = np.concatenate(owners), np.concatenate(ids)
    order = np.argsort(owner, kind="stable")
    return owner[order], feature[order]


@dataclass
class Field:
    """Weights of the field: per feature, per lexicon, per transition and for the first word."""

    languages: list[str]
    weights: np.ndarray
    lexicons: list[frozenset[str]]
    lexicon_weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    met: np.ndarray
    new_share: float

    def emissions(self, words: list[str]) -> np.ndarray:
        return self.read(words)[0]

    def read(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the words by language, and the numbers of their features and of those not met."""
        out = np.zeros((len(words), len(self.languages)), dtype=np.float32)
        features = np.zeros((len(words), 2), dtype=np.float32)
        if words:
            owner, feature = feature_ids(words)
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[first]] = np.add.reduceat(self.weights[feature], first, axis=0)
            out += self.members(words) @ self.lexicon_weights
            features[:, 0] = np.bincount(owner, minlength=len(words))
            features[:, 1] = np.bincount(owner, ~self.met[feature], len(words))
        return out, features

    def known(self, features: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Share of met features, one for each document."""
        beyond = np.maximum(0, new - self.new_share * features)
        return np.where(features > 0, 1 - beyond / (features + _GIVEN), 0.0)

    def members(self, words: list[str]) -> np.ndarray:
        found = [[w in lexicon for lexicon in self.lexicons] for w in words]
        return np.array(found, dtype=np.float32).reshape(len(words), len(self.lexicons))


@dataclass
class Lines:
    """Layout of many lines, step by step: ``order`` puts words into it, ``active`` has the lines
    that reach each step (longest first)."""

    order: np.ndarray
    active: np.ndarray

    @staticmethod
    def of(lengths: np.ndarray) -> Lines:
        rank = np.empty(len(lengths), dtype=np.int64)
        rank[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        active = np.bincount(step)
        begins = np.cumsum(active) - active
        to = begins[step] + np.repeat(rank, lengths)
        order = np.empty_like(to)
        order[to] = np.arange(len(to))
        return Lines(order, active)


def forward_backward(
    scores: np.ndarray, active: np.ndarray, transitions: np.ndarray, start: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each word's labels (laid out by ``Lines``), and expected transitions."""
    step = np.exp(transitions - transitions.max())
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))
    ends = np.cumsum(active)
    alpha, beta = np.empty_like(psi), np.ones_like(psi)
    for t, n in enumerate(active):
        at = slice(ends[t] - n, ends[t])
        before = alpha[ends[t - 1] - active[t - 1] :][:n] @ step if t else np.exp(start - start.max())
        now = psi[at] * before
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    total = np.zeros_like(step)
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        after = slice(ends[t + 1] - n, ends[t + 1])
        own = slice(ends[t] - active[t], ends[t] - active[t] + n)
        ahead = psi[after] * beta[after]
        back = ahead @ step.T
        beta[own] = back / back.sum(axis=1, keepdims=True)
        if pairs:
            joint = alpha[own][:, :, None] * step * ahead[:, None, :]
            total += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = alpha * beta
    return both / both.sum(axis=1, keepdims=True), total


def _spliced(rows: list[tuple[str, str]], seed: int) -> list[list[tuple[str, str]]]:
    """Lines as (word, language), a third of them with a stretch of another line put in."""
    draw = np.random.default_rng(seed)
    lines = [
        [(w, lang) for w in found]
        for lang, text in rows
        for line in text.lower().split("\n")
        if (found := [w for w in _TOKENS.findall(line) if w != "\n"])
    ]
    out = []
    for at in draw.permutation(len(lines)).tolist():
        line = lines[at]
        if draw.random() < 1 / 3:
            other = lines[int(draw.integers(len(lines)))]
            cut, begin = int(draw.integers(len(line) + 1)), int(draw.integers(len(other)))
            line = line[:cut] + other[begin : begin + int(draw.integers(3, 12))] + line[cut:]
        out.append(line)
    return out


def _met(rows: list[tuple[str, str]]) -> tuple[np.ndarray, float]:
    """Which features the texts have, and the share of all that occur once."""
    found = Counter(w for _, text in rows for w in _TOKENS.findall(text.lower()) if w != "\n")
    owner, feature = feature_ids(list(found))
    times = np.bincount(feature, np.array(list(found.values()))[owner], TABLE)
    return times > 0, float((times == 1).sum() / times.sum())


def fit(rows: list[tuple[str, str]], epochs: int = 4, lines_a_step: int = 200) -> Field | None:
    """Fit the field to (language, text) rows by Adam on the log-likelihood; None without words."""
    languages = sorted({lang for lang, _ in rows})
    place = {lang: i for i, lang in enumerate(languages)}
    lines = _spliced(rows, 1)
    if not lines:
        return None
    n = len(languages)
    counts = [Counter() for _ in languages]
    for line in lines:
        for w, lang in line:
            counts[place[lang]][w] += 1
    lexicons = [frozenset(w for w, k in c.most_common(LEXICON) if k > 1) for c in counts]
    params = [np.zeros((TABLE, n), np.float32), np.zeros((n, n), np.float32), np.zeros((n, n), np.float32), np.zeros(n, np.float32)]
    field = Field(languages, params[0], lexicons, params[1], params[2], params[3], *_met(rows))
    mean, power = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps = 0
    for _ in range(epochs):
        for at in range(0, len(lines), lines_a_step):
            part = lines[at : at + lines_a_step]
            lengths = np.array([len(x) for x in part])
            layout = Lines.of(lengths)
            flat = [x for line in part for x in line]
            seen: dict[str, int] = {}
            word = np.array([seen.setdefault(w, len(seen)) for w, _ in flat])[layout.order]
            gold = np.array([place[lang] for _, lang in flat])[layout.order]
            words = list(seen)
            post, expected = forward_backward(
                field.emissions(words)[word], layout.active, field.transitions, field.start, pairs=True
            )
            miss = -post
            miss[np.arange(len(gold)), gold] += 1
            by_word = np.zeros((len(words), n), np.float32)
            np.add.at(by_word, word, miss)
            owner, feature = feature_ids(words)
            grads = [np.zeros_like(params[0]), field.members(words).T @ by_word, -expected, miss[: len(part)].sum(axis=0)]
            for k in range(n):
                grads[0][:, k] = np.bincount(feature, by_word[owner, k], TABLE)
            labels = np.concatenate([[place[lang] for _, lang in x[:-1]] for x in part]).astype(int)
            nexts = np.concatenate([[place[lang] for _, lang in x[1:]] for x in part]).astype(int)
            np.add.at(grads[2], (labels, nexts), 1)
            steps += 1
            for p, g, m, v in zip(params, grads, mean, power, strict=True):
                g = g / len(flat) - 1e-6 * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += 0.05 * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-6)
    return field


def _labeller(field: Field) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(field.languages)
        known: dict[str, int] = {"\n": 0}
        scores, features = np.zeros((1, n), np.float32), np.zeros((1, 2), np.float32)

        def posteriors(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Whether each token is a word, the words' probabilities and their feature counts."""
            nonlocal scores, features
            if len(known) > _CACHE:
                known.clear()
                known["\n"] = 0
                scores, features = scores[:1], features[:1]
            new = list({w for w in tokens if w not in known})
            known.update((w, len(known)) for w in new)
            new_scores, new_features = field.read(new)
            scores = np.concatenate((scores, new_scores))
            features = np.concatenate((features, new_features))
            ids = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
            is_word = ids > 0
            cuts = np.flatnonzero(~is_word)
            lengths = np.diff(cuts, prepend=-1) - 1
            lengths = lengths[lengths > 0]
            out = np.empty((int(is_word.sum()), n), np.float32)
            if len(out):
                layout = Lines.of(lengths)
                laid = scores[ids[is_word][layout.order]]
                out[layout.order], _ = forward_backward(laid, layout.active, field.transitions, field.start)
            return is_word, out, features[ids[is_word]]

        def finish(tokens: list[str], sizes: list[int]) -> Iterator[tuple[str, float, float]]:
            is_word, post, counts = posteriors(tokens)
            owner = np.repeat(np.arange(len(sizes)), sizes)[is_word]
            total = np.bincount(owner, minlength=len(sizes))
            sums = np.stack([np.bincount(owner, post[:, k], len(sizes)) for k in range(n)], axis=1)
            best = sums.argmax(axis=1)
            share = field.known(*(np.bincount(owner, counts[:, k], len(sizes)) for k in (0, 1))).tolist()
            for k, words in enumerate(total.tolist()):
                if words:
                    yield field.languages[best[k]], float(min(1.0, sums[k, best[k]] / words)), share[k]
                else:
                    yield UNKNOWN, 0.0, 0.0

        for batch in batches:
            found: list[tuple[str, float, float]] = []
            tokens: list[str] = []
            sizes: list[int] = []
            for text in batch.column("text").to_pylist():
                own = _TOKENS.findall((text or "").lower())
                own = own if any(w != "\n" and any(map(str.isalpha, w)) for w in own) else []
                sizes.append(len(own) + 1)
                tokens += own
                tokens.append("\n")
                if len(tokens) >= _CHUNK:
                    found += finish(tokens, sizes)
                    tokens, sizes = [], []
            if sizes:
                found += finish(tokens, sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x for x, _, _ in found], pa.string()),
                    pa.array([x for _, x, _ in found], pa.float64()),
                    pa.array([x for _, _, x in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score", "known"],
            )

    return label


def _unknown(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("known"))


def identify(docs: DataFrame, learn: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """Predicted language of every document.

    ``docs`` needs ``doc_id`` and ``text``; ``learn`` (default: ``docs``) needs ``doc_id``, ``text``
    and ``lang``, and only its rows that are not held out and have both are learned from.  Other
    columns are not read.  Returns one row per input row: ``doc_id``, ``held_out``, ``lang_pred``,
    ``score`` (mean probability over the words), ``known`` (0 to 1, low for text in none of the learned
    languages).  A null text, or one without a letter, is ``und`` with score and ``known`` 0, and so
    is every text if nothing could be learned; an empty table gives an empty result.  Ties go to the first language
    by name; repeated rows get equal results.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    source = docs if learn is None else learn
    source = source.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    drawn, _ = sample_by(source, "lang", sample, SAMPLE_CHARS)
    field = fit(drawn)
    if field is None:
        found = _unknown(rows)
    else:
        found = rows.mapInArrow(_labeller(field), "doc_id bigint, lang_pred string, score double, known double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "known")
