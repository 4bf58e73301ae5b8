"""Url verdicts against plain versions of the rules, the splits and the classifier."""

import math
import re
from collections import Counter

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardledger.llm import urls
from tests.llm.brute import lower

EXTRA = "host string, words string, places string, score string, count string"
HTML = "<p class='x'>the best casino can win a cheap day</p> <b>best deal of the day</b> straße für das wetter win win "
#: (page_id, url, html)
PAGES = [
    (1, "https://bestcasinowin.example.org/en/7", HTML * 30), (2, "http://www.wetterfürstraße.example.net/de/1.html", HTML),
    (3, "HTTP://BestDealOfTheDay.Example.COM/en/1?x=://a.net/fr/", "<" * 500), (4, None, None), (5, "no scheme.com/en/", ""),
    (6, "://", "x"), (7, "https://example.com", None), (8, "https://example.com/en", None), (9, "https://example.com/en/?q#f", None),
    (10, "https://a.www.example.com/en/1", None), (11, "https://net/es/", None), (12, "https://subnet/es/1", None),
    (13, "https://x.net/fr/9#top", None), (14, "https://x.net#/fr/9", None), (15, "https://com.net/a/com/", None),
    (16, "ftp://user@x.com:80/p?://y.net/es/", None), (16, "ftp://user@x.com:80/p?://y.net/es/", None),
    (None, "https://" + "cheapcasino" * 400 + ".example.org/" + "long/" * 3000, "the a"), (None, None, "of"),
    (17, "https://cheapday.example.org/win", None), (18, "https://-1.2-.org//", None), (19, "https://𝔘x日本.org/日本", "日本 𝔘x"),
] + [(100 + i, "https://hot.example.net/en/4", "the") for i in range(20)]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, *["same"] * 5) for r in rows], f"page_id bigint, url string, html string, {EXTRA}")


def parts(url):
    found = re.match(r"(?s)\A.*?://([^/?#]*)([^?#]*)", url or "")
    return (lower(found[1]), found[2]) if found else ("", "")


def ruled(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def counted(rows):
    counts = Counter()
    for _, _, html in rows:
        counts.update(re.findall(urls._LETTERS, lower(re.sub("<[^<>]*>", " ", html or ""))))
    counts = Counter({w: n for w, n in counts.items() if len(w) <= urls.LONGEST})
    total = sum(counts.values())
    least = max(1, math.ceil(urls.SEED_SHARE * total))
    for w in urls.SEEDS:
        counts[w] = max(counts[w], least)
    return counts, max(total, 1)


def likely(words, counts, total):
    """Log probability of a split, known words or unknown rests."""
    return sum(max(math.log(counts[w]) if w in counts else -math.inf, -len(w) * math.log(10)) - math.log(total) for w in words)


def splits(run):
    for mask in range(2 ** (len(run) - 1)):
        cuts = [0, *[i + 1 for i in range(len(run) - 1) if mask >> i & 1], len(run)]
        yield [run[a:b] for a, b in zip(cuts, cuts[1:])]


def known(run, counts):
    return [(e, n, counts[run[e - n : e]]) for e in range(1, len(run) + 1) for n in range(1, e + 1) if run[e - n : e] in counts]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=9), st.dictionaries(st.text("abc", min_size=1, max_size=4), st.integers(1, 900), max_size=9))
def test_split_is_likeliest(run, counts):
    found = urls.split_run(run, known(run, counts), 1000)
    assert "".join(found) == run and all(found)
    best = max(likely(s, counts, 1000) for s in splits(run))
    assert likely(found, counts, 1000) == pytest.approx(best, abs=1e-9)


def test_runs_in_spark(spark):
    counts, total = urls.word_counts(frame(spark).select("html"))
    want, n = counted(PAGES)
    assert {r["word"]: r["count"] for r in counts.collect()} == want and total == n
    runs = ["bestcasinowin", "wetterfürstraße", "qqq", "cheapcasino" * 400, "日本𝔘x", "x" * 70, "a"]
    out = urls.split_runs(spark.createDataFrame([(r,) for r in runs], "run string"), counts, total).collect()
    assert {r["run"]: r["words"] for r in out} == {r: urls.split_run(r, known_short(r, want), n) for r in runs}
    assert {r["run"]: r["words"] for r in out}["bestcasinowin"] == ["best", "casino", "win"]


def known_short(run, counts):
    return [(e, n, counts[run[e - n : e]]) for e in range(1, len(run) + 1) for n in range(1, min(e, urls.LONGEST) + 1) if run[e - n : e] in counts]


def tokens(text):
    return re.findall(urls._TOKEN, re.sub("[0-9]+", "0", lower(text)))


def plain(rows):
    """Rows (host, path, rule, verdict, words, score)."""
    counts, total = counted(rows)
    tokenised = []
    for _, url, _ in rows:
        host, path = parts(url)
        words = [w for t in tokens(host) for w in (["0"] if t == "0" else urls.split_run(t, known_short(t, counts), total))]
        tokenised.append((host, path, words, words + tokens(path)))
    place = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64 - 2**63
    seen = [Counter(), Counter()]
    number = [0, 0]
    for *_, own in tokenised:
        block = any(t in urls.SEEDS for t in own)
        number[block] += 1
        seen[block].update(place(t) % urls.PLACES for t in own)
    sums = [sum(c.values()) for c in seen]
    out = []
    for host, path, words, own in tokenised:
        odds = math.log((number[1] + 0.5) / (number[0] + 0.5))
        for p in (place(t) % urls.PLACES for t in own):
            share = (seen[0][p] + seen[1][p]) / sum(sums)
            odds += math.log((seen[1][p] + share) / (sums[1] + 1)) - math.log((seen[0][p] + share) / (sums[0] + 1))
        rule, verdict = ruled(host, path)
        score = 1 / (1 + math.exp(-max(-700, min(700, odds))))
        out.append((host, path, rule, verdict or ("block" if score >= 0.5 else "allow"), " ".join(words), score))
    return out


def test_verdicts(spark):
    got = urls.url_verdicts(frame(spark)).collect()
    want = sorted(zip((str(p[0]) for p in PAGES), plain(PAGES)), key=str)
    found = sorted(((str(r["page_id"]), tuple(r)[1:]) for r in got), key=str)
    assert len(found) == len(want)
    for (i, own), (j, plan) in zip(found, want):
        assert i == j and own[:5] == plan[:5]
        assert own[5] == pytest.approx(plan[5], rel=1e-6, abs=1e-12)
    verdicts = {r["page_id"]: (r["rule"], r["verdict"]) for r in got}
    assert verdicts[2] == (None, "allow")
    assert verdicts[3] == ("example.com/en/", "block") and verdicts[10] == ("www.example.com/en/", "allow")
    assert verdicts[4] == verdicts[5] == verdicts[6] == verdicts[7] == (None, "allow")
    assert verdicts[8] == ("com/", "allow") and verdicts[9] == ("example.com/en/", "block")
    assert verdicts[11] == ("net/es/", "block") and verdicts[12][0] is None and verdicts[14][0] is None


def test_company_of_seeds_is_learned(spark):
    """Words that go with seeds are evidence by themselves: held-out hosts without a seed word."""
    html = "the day best farm win cheap track weather news paper garden house " * 50
    bad, good = ["cheap", "win", "track"], ["weather", "garden", "house", "news"]
    rows = [(i, f"https://{bad[i % 3]}casino.example.org/{i}", html) for i in range(60)]
    rows += [(100 + i, f"https://{good[i % 4]}{good[i // 4 % 4]}.example.org/{i}", html) for i in range(240)]
    rows += [(1000 + i, f"https://{bad[i % 3]}{bad[i // 3 % 3]}.example.org/{i}", None) for i in range(9)]
    rows += [(2000 + i, f"https://{good[i % 4]}day.example.org/{i}", None) for i in range(9)]
    out = {r["page_id"]: r["verdict"] for r in urls.url_verdicts(frame(spark, rows)).collect()}
    assert all(out[1000 + i] == "block" for i in range(9)) and all(out[2000 + i] == "allow" for i in range(9))


def test_no_pages_and_no_words(spark):
    assert urls.url_verdicts(frame(spark, [])).collect() == []
    bare = urls.url_verdicts(frame(spark, [(1, None, None), (1, None, None), (2, "https://casino.example.org/", None), (3, "https://news.example.org/", None)]))
    assert {r["page_id"]: r["verdict"] for r in bare.collect()} == {1: "allow", 2: "block", 3: "allow"}
    assert bare.select("host").distinct().count() == 3
    names = [r[0] for r in bare.select(F.array_sort(F.split("words", " "))).collect()]
    assert ["casino", "example", "org"] in names
