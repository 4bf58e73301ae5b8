"""SimHash near-duplicates through an inverted index on fingerprint bytes.

Two fingerprints that differ in at most 4 of 64 bits agree in at least 4 of their 8 bytes.  The
index lists, for each byte position and value, the fingerprints that have it there.  A list of one
byte holds a 256th of everything, so lists are kept for three positions at once: 20 triples are
enough for every choice of 4 positions to contain one of them.  Along a list the shared positional
bytes of each pair are tallied, pairs with fewer than 4 are dropped and the rest is verified bit by
bit.  Lists are searched breadth first and a fingerprint leaves its list once it is reached, so a
dense group of near copies costs its size and yields a tree instead of all its pairs.

Equal fingerprints are one class before anything is paired, so a list holds distinct ones only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import store, tasks
from cardledger.llm.components import components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BYTES = 8
#: Byte positions in three groups.
_GROUPS = ((0, 1, 2), (3, 4, 5), (6, 7))
#: Rows of the bit matrix that is summed at a time.
_BLOCK = 65_536


def _covering() -> list[tuple[int, int, int]]:
    """Triples of positions such that any 4 positions contain one: three of a group, or two of a
    group and one of the next."""
    found = [t for g in _GROUPS for t in combinations(g, 3)]
    for g, following in zip(_GROUPS, _GROUPS[1:] + _GROUPS[:1], strict=True):
        found += [(*pair, other) for pair in combinations(g, 2) for other in following]
    return [tuple(sorted(t)) for t in found]


TRIPLES = _covering()


def fingerprint(text: bytes | None, k: int = SHINGLE) -> int:
    """SimHash of the k-word shingles, repeats included; fewer words make one shingle, none gives 0."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[k - 1 :] if len(found) >= k else ends[-1:]
    hashed = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), last.tolist(), strict=False)
    h = np.fromiter((hashed(line[a:b], SEED) for a, b in spans), np.uint64, len(last))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), _BLOCK):
        bits = np.unpackbits(h[at : at + _BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(x) for x in batch.column("text").cast(pa.binary()).to_pylist()]
        signed = np.array(found, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(signed, pa.int64())], ["doc_id", "fp"]
        )


def _tree(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all fingerprints of one list which are within reach of each other."""
    links: list[tuple[int, int]] = []
    rest = np.arange(len(fps))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            seed = queue.pop()
            differing = fps[rest] ^ fps[seed]
            tally = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
            near = np.flatnonzero(tally >= BYTES - MAX_BITS)
            near = near[np.bitwise_count(differing[near]) <= MAX_BITS]
            if len(near):
                reached = rest[near]
                links += [(seed, x) for x in reached.tolist()]
                queue += reached.tolist()
                rest = np.delete(rest, near)
    return links


def _along_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the posting lists of a partition that is sorted by list."""

    def links(lists: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(lists)) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(lists)]))
        a, b = [], []
        for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
            own = fps[s:e]
            for x, y in _tree(own):
                a.append(own[x])
                b.append(own[y])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(x, dtype=np.uint64).view(np.int64), pa.int64()) for x in (a, b)], ["a", "b"]
        )

    lists, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        lists = np.concatenate((lists, batch.column("list").to_numpy()))
        fps = np.concatenate((fps, batch.column("fp").to_numpy().view(np.uint64)))
        if not len(lists):
            continue
        whole = int(np.searchsorted(lists, lists[-1]))  # the last list may go on
        if whole:
            yield links(lists[:whole], fps[:whole])
        lists, fps = lists[whole:], fps[whole:]
    if len(lists):
        yield links(lists, fps)


def near_links(fps: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect all of the distinct fingerprints in column ``fp`` which are
    within 4 bits of each other, directly or over others."""
    byte = [F.shiftrightunsigned(F.col("fp"), 8 * i).bitwiseAND(F.lit(255)) for i in range(BYTES)]
    lists = [
        F.lit(n << 24) + F.shiftleft(byte[x], 16) + F.shiftleft(byte[y], 8) + byte[z]
        for n, (x, y, z) in enumerate(TRIPLES)
    ]
    posted = fps.select("fp", F.explode(F.array(*lists)).alias("list"))
    dealt = posted.repartition(tasks(fps.sparkSession), "list").sortWithinPartitions("list")
    return dealt.mapInArrow(_along_lists, "a bigint, b bigint")


def simhash_components(docs: DataFrame) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  Returns one row per input
    row: ``doc_id``, ``fingerprint`` (16 lowercase hex digits), ``component_id`` (least ``doc_id``
    reachable over links of at most 4 differing bits).  A null or blank text has fingerprint zero,
    which links like any other.  Repeated rows stay; a null ``doc_id`` belongs to its component and
    never names it unless it has no other.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    each = store(rows.mapInArrow(_fingerprints, "doc_id bigint, fp bigint"), "fingerprints")
    classes = store(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = store(components(near_links(classes.select("fp"))), "roots").withColumnRenamed("node", "fp")
    known = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(named, "root").select("fp", "component_id")
    return each.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
