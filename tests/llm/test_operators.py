import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardledger.llm import components, licenses, simhash, suffixes
from cardledger.llm.common import words
from cardledger.llm.decontaminate import decontaminate
from cardledger.llm.exact import CuckooFilter, DigestIndex, exact_dedup
from cardledger.llm.lines import line_dedup
from cardledger.llm.sharding import pack, vector_shards
from tests.llm import brute

ITEMS = [
    (1, brute.LEAK), (2, "Only THREE words"), (3, None), (4, "--"), (5, brute.PROSE), (None, "12 34"),
    (1, "the lazy dog"), (6, "words"),
]
ITEM_COLUMNS = "item_id bigint, text string, span string, mark string"


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ITEM_COLUMNS)


def empty(spark):
    return brute.frame(spark, [])


def test_words_lower_only_ascii(spark):
    df = brute.frame(spark).select("doc_id", "text", words(F.col("text")).alias("found"))
    for r in df.collect():
        assert r["found"] == brute.words(r["text"])


def test_exact(spark):
    out = exact_dedup(brute.frame(spark)).collect()
    want = brute.exact(brute.DOCS)
    assert len(out) == len(brute.DOCS)
    for r in out:
        assert (r["keep_id"], r["group_size"], r["text_sha256"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["keep_id"])


def test_exact_repeated_withdrawn_and_empty(spark):
    out = [r for r in exact_dedup(brute.frame(spark, repeat=True)).collect() if r["doc_id"] == 5]
    assert len(out) == 2 and {r["group_size"] for r in out} == {4}
    marked = brute.frame(spark).withColumn("gone", F.col("doc_id").isin(18, 21, 19))
    got = brute.by_id(exact_dedup(marked, "gone"))
    assert got[5]["keep_id"] == 3 and got[5]["group_size"] == 2
    assert got[18]["keep_id"] is None and not got[18]["kept"] and got[18]["group_size"] is None
    assert got[-2]["keep_id"] == -2 and got[-2]["group_size"] == 1
    assert exact_dedup(empty(spark)).collect() == []


def test_cuckoo_filter_has_no_false_negatives_and_deletes():
    keys = [int(x) for x in np.random.default_rng(3).integers(1, 2**64, 3000, dtype=np.uint64)]
    index = DigestIndex(buckets=4)  # must grow many times
    for k in keys:
        index.entry(k, k.to_bytes(8, "big"))[1] += 1
    assert all(k in index.filter for k in keys) and len(index.contents) == len(keys)
    assert index.entry(keys[0], keys[0].to_bytes(8, "big"))[1] == 1
    index.entry(keys[0], b"other content of the same digest")
    assert len(index.contents[keys[0]]) == 2
    for k in keys[:1500]:
        index.delete(k, k.to_bytes(8, "big"))
    assert keys[0] in index.filter  # the other content lives
    assert all(k in index.filter for k in keys[1500:])
    assert sum(k in index.filter for k in keys[1:1500]) < 60
    small = CuckooFilter(1)
    assert [small.insert(k) for k in keys[:5]] == [True] * 4 + [False]


def test_released_digests_stay_known_through_growth():
    index = DigestIndex(buckets=4)
    keys = [int(x) for x in np.random.default_rng(4).integers(1, 2**64, 2000, dtype=np.uint64)]
    for place, k in enumerate(keys):
        content = k.to_bytes(8, "big")
        index.entry(k, content)[1] += place % 4 != 0
        index.entry(k, b"withdrawn")  # of the same digest, without a live row
        assert [one[0] for one in index.release(k)] == ([content] if place % 4 else [])
        assert not index.contents
    live = [k for place, k in enumerate(keys) if place % 4]
    assert all(k in index.filter for k in live)
    assert sum(k in index.filter for k in keys[::4]) < 60
    assert index.release(keys[1]) == []


def test_exact_in_many_small_buckets(spark):
    """Withdrawn rows, and two contents of one bucket, in the order of their digests."""
    rows = [(i, f"text {i % 37}" + " " * (i % 3), "en") for i in range(400)] + [(1000, None, "en"), (1001, " \n", "en")]
    df = brute.frame(spark, rows).withColumn("gone", (F.col("doc_id") % 37 < 5) | (F.col("doc_id") % 7 == 0))
    got = brute.by_id(exact_dedup(df.repartition(16), "gone"))
    stay = [r for r in rows if not (r[0] % 37 < 5 or r[0] % 7 == 0)]
    want = brute.exact(stay)
    assert len(got) == len(rows)
    for i, text, _ in rows:
        r = got[i]
        assert (r["keep_id"], r["group_size"]) == (want[i][:2] if i in want else (None, None))
        assert r["kept"] == (i in want and want[i][0] == i)


def test_repeats(spark):
    out = suffixes.remove_repeats(brute.frame(spark)).collect()
    want = brute.repeats(brute.DOCS)
    assert len(out) == len(brute.DOCS)
    for r in out:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want[r["doc_id"]], r["doc_id"]
    assert sum(r["n_removed"] for r in out) > 10_000


def test_repeats_repeated_rows_and_empty(spark):
    twice = [r for r in suffixes.remove_repeats(brute.frame(spark, [brute.DOCS[0]], repeat=True)).collect()]
    assert sorted(r["n_removed"] for r in twice)[1] == len(brute.DOCS[0][1])
    assert suffixes.remove_repeats(empty(spark)).collect() == []


def test_repeats_over_many_blocks(spark, monkeypatch):
    """Shifted and overlapping repeats between blocks, between buckets and inside a text."""
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abcdefgh "), 3000))
    rows = []
    for i in range(60):
        a, n = int(rng.integers(0, 2500)), int(rng.integers(40, 500))
        own = "".join(rng.choice(list("abcdefgh "), int(rng.integers(0, 200))))
        rows.append((int(rng.integers(-50, 10**6)), own + base[a : a + n] + own[::-1] + "é" * (i % 3), "en"))
    got = brute.by_id(suffixes.remove_repeats(brute.frame(spark, rows).repartition(5)))
    for i, want in brute.repeats(rows).items():
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want


def edges(n: int) -> list[tuple[int, str, str]]:
    """Documents that share a passage, each with its own text beside it."""
    rng = np.random.default_rng(6)
    draw = lambda size: "".join(rng.choice(list("abcdefgh "), size))
    passage = draw(600)
    return [(i, draw(150) + passage + draw(150), "en") for i in range(n)]


def test_edges_of_a_passage_do_not_meet_in_one_bucket():
    rows = edges(400)
    ends = np.cumsum([len(t) for _, t, _ in rows], dtype=np.int64)
    data = "".join(t for _, t, _ in rows).encode()
    row = {"block": 0, "ids": np.arange(400).tobytes(), "ends": ends.tobytes(), "data": data}
    block = suffixes.Block(row)
    hashes, none = suffixes.Hashes(block.data), np.empty(0, np.uint64)
    live = suffixes._live(block, hashes, none)

    def largest(hot):
        begins, after, key = suffixes._stretches(block, hashes, live.copy(), hot, none)
        _, first = np.unique(hashes.of(begins, after + suffixes.LENGTH - 1), return_index=True)
        keys, n = np.unique(key[first], return_counts=True)
        return n.max(), keys[n > 40]

    n, hot = largest(none)
    assert n > 300
    assert largest(hot)[0] <= 40


@pytest.mark.parametrize("hot", [0, 40])
def test_repeats_with_split_keys(spark, hot):
    rows = [*edges(120), (500, brute.PROSE * 9, "en"), (501, brute.PROSE * 9, "en"), (None, brute.PROSE * 5, "en")]
    got = brute.by_id(suffixes.remove_repeats(brute.frame(spark, rows).repartition(16), hot=hot))
    for i, want in brute.repeats(rows).items():
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want


def test_difference_cover_and_colliding_names(monkeypatch):
    met = {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER}
    assert met == set(range(suffixes.PERIOD))
    text = np.frombuffer((b"ab" * 90) + b"c" * 120, np.uint8)
    starts = np.arange(len(text) - suffixes.LENGTH + 1)
    plain = suffixes._later(text, starts)
    monkeypatch.setattr(suffixes.Hashes, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    assert (suffixes._later(text, starts) == plain).all()  # bytes decide where names collide


@pytest.mark.parametrize("rows", [ITEMS, ITEMS[:1], [], ITEMS[2:4]])
def test_leaks(spark, rows):
    out = decontaminate(brute.frame(spark), items(spark, rows)).collect()
    want = brute.leaks(brute.DOCS, rows)
    assert len(out) == len(brute.DOCS)
    for r in out:
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == want[r["doc_id"]], r["doc_id"]
        assert r["n_items"] == len(r["item_ids"]) and r["contaminated"] == (r["n_hit"] > 0)


def test_leaks_repeated_rows_and_empty(spark):
    out = decontaminate(brute.frame(spark, repeat=True), items(spark)).where("doc_id = 5").collect()
    assert len(out) == 2 and out[0] == out[1] and out[0]["contaminated"]
    assert decontaminate(empty(spark), items(spark)).collect() == []


def test_simhash(spark):
    out = brute.by_id(simhash.simhash_components(brute.frame(spark)))
    fps = {i: brute.simhash(t) for i, t, _ in brute.DOCS}
    want = brute.near(fps)
    assert {i: int(r["fingerprint"], 16) for i, r in out.items()} == fps
    assert {i: r["component_id"] for i, r in out.items()} == want
    assert all(len(r["fingerprint"]) == 16 for r in out.values())
    assert simhash.simhash_components(empty(spark)).collect() == []
    assert simhash.simhash_components(brute.frame(spark, repeat=True)).count() == len(brute.DOCS) + 1


def test_any_four_bytes_hold_a_listed_triple():
    for four in itertools.combinations(range(8), 4):
        assert any(set(t) <= set(four) for t in simhash.TRIPLES)
    assert len(set(simhash.TRIPLES)) == len(simhash.TRIPLES) == 20


def test_links_join_all_within_reach(spark):
    """Dense groups, chains and strangers, against all pairs."""
    rng = np.random.default_rng(11)
    fps: set[int] = {0, 2**64 - 1}
    for _ in range(12):
        at = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(25):
            fps.add(at)
            for bit in rng.integers(0, 64, int(rng.integers(1, 7))):
                at ^= 1 << int(bit)
    signed = {x: int(np.uint64(x).view(np.int64)) for x in fps}
    df = spark.createDataFrame([(x,) for x in signed.values()], "fp bigint")
    roots = {r["node"]: r["root"] for r in components.components(simhash.near_links(df)).collect()}
    want = brute.near({signed[x]: x for x in fps})
    groups = {}
    for node, root in want.items():
        groups.setdefault(root, set()).add(node)
    for members in groups.values():
        assert len({roots.get(m, m) for m in members}) == 1
    assert len({roots.get(m, m) for m in want}) == len(groups)


def test_components_of_chains_and_loops(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 100), (7, 100), (200, 201), (201, 200), (201, 200)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in [*range(41), 100]}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_licenses(spark):
    rows = brute.DOCS + [
        (30, " ".join(["filler"] * 31) + " under the mit license " + brute.PROSE * 9 + "apache license version 2", "en"),
        (31, licenses.TEMPLATES[2][1].replace("forms", "form") + " in " + licenses.TEMPLATES[0][1].title(), "en"),
        (32, "license mit the under. Under the MIT under the MIT license", "en"),
    ]
    out = licenses.license_scan(brute.frame(spark, rows)).collect()
    want = brute.licenses(rows, licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD, licenses.STRIDE)
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r)[1:-1] == want[r["doc_id"]][:-1], r["doc_id"]
        assert r["score"] == pytest.approx(want[r["doc_id"]][-1])
    got = {r["doc_id"]: r for r in out}
    assert got[31]["labels"] == "bsd,mit" and got[31]["base_labels"] == ""


def test_licenses_repeated_rows_empty_and_bad_templates(spark):
    rows = [(16, brute.DOCS[12][1], "en")] * 2
    out = licenses.license_scan(brute.frame(spark, rows)).collect()
    assert len(out) == 2 and out[0] == out[1] and out[0]["n_base"] == 4
    assert licenses.license_scan(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        licenses.license_scan(empty(spark), [("long", "w " * 40)])


def test_lines(spark):
    out = line_dedup(brute.frame(spark)).collect()
    seen: dict[str, tuple] = {}
    order = sorted(brute.DOCS, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, text, _ in order:
        for k, chunk in enumerate(brute.chunks(text)):
            if len(chunk) > 1:
                seen.setdefault("\n".join(chunk), (i, k))
    assert len(out) == len(brute.DOCS)
    texts = {i: t for i, t, _ in brute.DOCS}
    for r in out:
        own = brute.chunks(texts[r["doc_id"]])
        gone = [k for k, c in enumerate(own) if len(c) > 1 and seen["\n".join(c)] != (r["doc_id"], k)]
        left = "\n".join("\n".join(c) for k, c in enumerate(own) if k not in gone)
        assert (r["text"], r["n_chunks"], r["n_removed"]) == (left, len(own), len(gone)), r["doc_id"]
        assert r["n_lines"] == sum(map(len, own)) and r["n_removed_lines"] == sum(len(own[k]) for k in gone)
    assert sum(r["n_removed"] for r in out) > 50


def test_lines_boundaries_shift_and_repeated_rows(spark):
    a, b = brute.chunks(brute.DOCS[10][1]), brute.chunks("new first line\n" + brute.DOCS[10][1])
    assert a[1:] == b[-len(a) + 1 :]
    twice = line_dedup(brute.frame(spark, [(1, "a\nb\nc\nd\ne\nf\ng", "en")] * 2)).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0]["n_removed"] == 0
    assert line_dedup(empty(spark)).collect() == []


def shard_rows(df):
    rows = df.collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return rows, by


def test_shards(spark):
    rows, by = shard_rows(vector_shards(brute.frame(spark, repeat=True)))
    assert len(rows) == len(brute.DOCS) + 1 and all(0 <= s < 24 for s in by)
    texts = {i: (t or "").encode() for i, t, _ in brute.DOCS}
    for r in rows:
        own = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(own) + 8, zlib.crc32(own), "bytes", None)
    assert vector_shards(empty(spark)).collect() == []


def test_shards_balance_and_hot_group(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.lognormal(4, 1)), "en") for i in range(3000)]
    rows += [(10_000 + i, "one text that a third of the rows share", "en") for i in range(1500)]
    out, by = shard_rows(vector_shards(brute.frame(spark, rows)))
    sizes = [sum(r["size"] for r in own) for own in by.values()]
    counts = [len(own) for own in by.values()]
    assert len(by) == 24 and max(sizes) - min(sizes) < 0.03 * np.mean(sizes)
    assert max(counts) < 1.25 * np.mean(counts)
    texts = {i: t for i, t, _ in rows if i < 10_000}
    together = {}
    for r in out:
        if r["doc_id"] in texts:
            assert together.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"]


@pytest.mark.parametrize("shared", [None, 7])
def test_shards_of_a_hot_group_with_one_id(spark, shared):
    rows = [(i, f"{'w ' * (10 + i % 90)}{i}", "en") for i in range(1200)] + [(shared, "a text of a third of the rows " * 4, "en")] * 600
    out, by = shard_rows(vector_shards(brute.frame(spark, rows).repartition(5)))
    sizes = [sum(r["size"] for r in own) for own in by.values()]
    assert len(out) == 1800 and len(by) == 24 and max(sizes) - min(sizes) < 0.03 * np.mean(sizes)
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in by.values())


def test_shards_agree_with_plain_packing(spark):
    rows = [(i, f"{'w ' * (i * 37 % 200)}{i}", "en") for i in range(900)] + [(5000 + i, "copy " * 40, "en") for i in range(30)]
    out, _ = shard_rows(vector_shards(brute.frame(spark, rows)))
    shard_of = {r["doc_id"]: r["shard"] for r in out}
    assert brute.packing_gap(rows, 24, shard_of) < 1e-9
    assert brute.packing_gap(rows, 24, shard_of | {3: (shard_of[3] + 1) % 24}) > 1e-6


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(0, 30))
def test_pack_uses_up_residual(sizes, turn):
    units = np.sort(np.array(sizes, float))[::-1].reshape(-1, 1) @ np.ones((1, 3)) / 100
    room = np.ones((6, 3))
    chosen = pack(units, room, turn)
    for s in range(6):
        assert room[s, 0] == pytest.approx(1 - units[chosen == s, 0].sum())
    if sizes:
        assert room[:, 0].max() - room[:, 0].min() <= max(sizes) / 100 + 1e-9
