"""Verdicts on urls: block and allow rules first, then a classifier over the words of host and path.

Hosts run words together (``bestcasinowin``).  A unigram model, counted over the words of all page
texts, splits every distinct run of letters of the hosts by Viterbi: the likeliest sequence of
known words and unknown rests.  The words of the host, the digits (as ``0``) and the plain words
of the path are the tokens of a url, and multinomial naive Bayes scores them.

There are no labels, so it learns from seeds: a url one of whose tokens is a seed word counts as
blocked, any other as allowed, and the words that keep company with seeds become evidence of
their own.  Counts cover all urls.  The token table has a fixed number of hashed places
(``PLACES``), so the model that tasks get has one size whatever the input; nothing is left out of it.

Only words that a host can hold are looked up: the stretches of the distinct runs meet the counted
words in a join, so no vocabulary is collected or bounded.

Null urls, and urls without ``://``, have an empty host and path, no rule, no tokens, and the
verdict of the prior.  Rows are never joined on their id: repeated and null ids give a row each.  Of equally
likely splits the one whose last differing word is longer counts; a word is at most ``LONGEST``
letters, an unknown rest has any length.  Without pages nothing is returned.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import lower_ascii, store

#: Rules (verdict, host, path): a rule fits its host and all subdomains below a path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Words that mark a url as unwanted.
SEEDS = ("ads", "adult", "bets", "casino", "escorts", "gambling", "pills", "poker", "porn", "spam", "viagra", "xxx")
#: Share of all counted words that a seed has at least, so that the splits can find it.
SEED_SHARE = 1e-4
#: Letters of the longest word that the unigram model knows.
LONGEST = 24
PLACES = 2**18
#: Cost of a letter of an unknown rest.
_LETTER = math.log(10)
_LETTERS = r"[^\x00-\x60\x7B-\x7F]+"
_TOKEN = r"0|[^\x00-\x60\x7B-\x7F]+"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path of a url; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"\A[^?#]*", 0)
    return lower_ascii(host), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, own, below in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(below))
        name = F.when(fits, F.lit(own + below)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def word_counts(html: DataFrame, seeds: tuple[str, ...] = SEEDS) -> tuple[DataFrame, int]:
    """(word, count) over the texts of ``html``, tags taken out, and the number of words."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"<[^<>]*>", " ")
    words = html.select(F.explode(_all(lower_ascii(text), _LETTERS)).alias("word"))
    counts = store(words.groupBy("word").count().where(F.length("word") <= LONGEST), "words")
    total = counts.agg(F.sum("count")).first()[0] or 0
    least = max(1, math.ceil(SEED_SHARE * total))
    given = counts.sparkSession.createDataFrame([(w, least) for w in seeds], "word string, count bigint")
    counts = counts.unionByName(given).groupBy("word").agg(F.max("count").alias("count"))
    return counts, max(total, 1)


def split_run(run: str, known: list[tuple[int, int, int]], total: int) -> list[str]:
    """Likeliest words of a run of letters.

    ``known`` has the places of known words: end, length and count.  An unknown rest of n letters has
    probability 10^-n / total.
    """
    ends: dict[int, list[tuple[int, int]]] = {}
    for end, length, count in known:
        ends.setdefault(end, []).append((length, count))
    base = math.log(total)
    best, back = [0.0] * (len(run) + 1), [0] * (len(run) + 1)
    room, begin = 0.0, 0  # of an unknown rest: where it best begins, and that place's score without the rest's letters
    for i in range(1, len(run) + 1):
        score, at = room - i * _LETTER - base, begin
        for length, count in ends.get(i, ()):
            own = best[i - length] + math.log(count) - base
            if own > score or (own == score and i - length < at):
                score, at = own, i - length
        best[i], back[i] = score, at
        if score + i * _LETTER > room:
            room, begin = score + i * _LETTER, i
    found, i = [], len(run)
    while i:
        found.append(run[back[i] : i])
        i = back[i]
    return found[::-1]


def split_runs(runs: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(run, words) of distinct runs of letters."""
    # Long runs go by their hash, so that a stretch never carries more than itself.
    key = F.when(F.length("run") <= 64, F.col("run")).otherwise(F.concat(F.lit("#"), F.md5("run")))
    runs = runs.withColumn("key", key)
    letters = r"(?s)(.)(?=(.{0,%d}))" % (LONGEST - 1)
    windows = F.zip_with(
        F.regexp_extract_all("run", F.lit(letters), F.lit(1)), F.regexp_extract_all("run", F.lit(letters), F.lit(2)),
        lambda first, rest: F.concat(first, rest),
    )
    places = runs.select("key", F.posexplode(windows).alias("place", "window"))
    stretches = places.select("key", "place", "window", F.explode(F.sequence(F.lit(1), F.length("window"))).alias("length"))
    stretches = stretches.select(
        "key", (F.col("place") + F.col("length")).alias("end"), "length", F.substr("window", F.lit(1), F.col("length")).alias("word")
    )
    known = stretches.join(counts, "word").groupBy("key").agg(F.collect_list(F.struct("end", "length", "count")).alias("known"))

    @F.pandas_udf("array<string>")
    def words(run: pd.Series, known: pd.Series) -> pd.Series:
        own = [[] if k is None else [(w["end"], w["length"], w["count"]) for w in k] for k in known]
        return pd.Series([split_run(r, k, total) for r, k in zip(run, own)])

    return runs.join(known, "key", "left").select("run", words("run", "known").alias("words"))


def _tokens(text: Column) -> Column:
    return _all(F.regexp_replace(lower_ascii(text), "[0-9]+", "0"), _TOKEN)


def host_words(hosts: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(host, words) of distinct hosts that have any."""
    items = store(hosts.select("host", F.posexplode(_tokens(F.col("host"))).alias("place", "run")), "runs")
    split = split_runs(items.where(F.col("run") != "0").select("run").distinct(), counts, total)
    words = F.coalesce("words", F.array(F.lit("0")))
    found = items.join(split, "run", "left").select("host", F.struct("place", words.alias("words")).alias("part"))
    ordered = F.sort_array(F.collect_list("part"))
    return found.groupBy("host").agg(F.flatten(F.transform(ordered, lambda p: p["words"])).alias("words"))


def token_weights(urls: DataFrame) -> tuple[np.ndarray, float]:
    """Log odds of each hashed place, and of no token, from ``places`` and ``seeded`` of all urls.

    A place's share in a class is smoothed by its share among all urls, so classes of unlike sizes
    do not tilt what neither has seen.
    """
    seen = np.zeros((2, PLACES))
    rows = urls.select("seeded", F.explode("places").alias("place")).groupBy("seeded", "place").count().toPandas()
    seen[rows["seeded"].to_numpy(dtype=int), rows["place"].to_numpy(dtype=int)] = rows["count"]
    urls_of = {r["seeded"]: r["count"] for r in urls.groupBy("seeded").count().collect()}
    share = seen.sum(axis=0) / max(seen.sum(), 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        likely = np.log((seen + share) / (seen.sum(axis=1, keepdims=True) + 1))
        weights = np.where(share > 0, likely[1] - likely[0], 0.0)
    return weights, math.log((urls_of.get(True, 0) + 0.5) / (urls_of.get(False, 0) + 0.5))


def _scorer(weights: np.ndarray, prior: float):
    @F.pandas_udf("double")
    def score(places: pd.Series) -> pd.Series:
        sizes = places.str.len().to_numpy()
        flat = weights[np.concatenate([[0], *places]).astype(np.int64)]
        flat[0] = 0.0
        ends = flat.cumsum()[np.cumsum(sizes)]
        odds = prior + np.diff(ends, prepend=0.0)
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -700, 700))))

    return score


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """A row for each row of ``pages`` (``page_id``, ``url``, ``html``): host, path, rule (null if none fits),
    verdict (the rule's, else block from even odds on), the host's words and the score."""
    counts, total = word_counts(pages.select("html"), seeds)
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    words = store(host_words(urls.select("host").distinct(), counts, total), "hosts")
    name, decision = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.join(words, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    tokens = F.concat("words", _tokens(F.col("path")))
    places = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(PLACES)).cast("int"))
    seeded = F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in seeds]))
    urls = urls.select(
        "page_id", "host", "path", name.alias("rule"), decision.alias("decision"),
        F.array_join("words", " ").alias("words"), places.alias("places"), seeded.alias("seeded"),
    )
    urls = store(urls, "urls")
    scored = urls.withColumn("score", _scorer(*token_weights(urls))("places"))
    verdict = F.coalesce("decision", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "words", "score")
