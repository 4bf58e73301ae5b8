"""Exact duplicates through a cuckoo-filter index over content digests.

Every task first folds equal contents of an Arrow batch into one row, so a text that a third of all
rows share reaches its index bucket once per batch.  The rows are dealt by digest and sorted by it
(Spark spills that sort).  A bucket holds a cuckoo filter over its live digests and their keys: a miss
in the filter proves a new text, a hit is settled by comparing the bytes with the contents of the
digest that is being read.  A filter that overflows is built anew, twice as large, from the stored
keys.  Withdrawn rows take their digest out again if no live row is left.

A task keeps the contents of one digest and an Arrow batch, besides 10 to 20 bytes for a digest.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import tasks

#: Characters that do not count in a comparison: space and \t \n \v \f \r.
BLANKS = b" \t\n\x0b\x0c\r"
_SLOTS, _KICKS, _ODD = 4, 200, 0x5BD1E995


class CuckooFilter:
    """Set of 64-bit keys as 16-bit fingerprints in buckets of four; no false negatives."""

    def __init__(self, buckets: int = 1024) -> None:
        self.mask = buckets - 1
        self.slots = array("H", bytes(2 * _SLOTS * buckets))

    def _places(self, key: int) -> tuple[int, int, int]:
        mark = (key >> 48) or 1
        first = key & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * _ODD)) & self.mask

    def _swap(self, bucket: int, old: int, new: int) -> bool:
        for at in range(bucket * _SLOTS, (bucket + 1) * _SLOTS):
            if self.slots[at] == old:
                self.slots[at] = new
                return True
        return False

    def __contains__(self, key: int) -> bool:
        mark, first, second = self._places(key)
        at, to = first * _SLOTS, second * _SLOTS
        return mark in self.slots[at : at + _SLOTS] or mark in self.slots[to : to + _SLOTS]

    def insert(self, key: int) -> bool:
        """Whether there was room; without, the filter has lost a mark and must be built anew."""
        mark, first, second = self._places(key)
        if self._swap(first, 0, mark) or self._swap(second, 0, mark):
            return True
        bucket = second
        for kick in range(_KICKS):
            at = bucket * _SLOTS + kick % _SLOTS
            mark, self.slots[at] = self.slots[at], mark
            bucket = self._other(bucket, mark)
            if self._swap(bucket, 0, mark):
                return True
        return False

    def delete(self, key: int) -> bool:
        """Take one inserted key out; whether a mark of it was there."""
        mark, first, second = self._places(key)
        return self._swap(first, mark, 0) or self._swap(second, mark, 0)


class DigestIndex:
    """Live digests of one bucket: the filter answers first, the contents decide.

    Contents can be released when no more rows of their digest come; the keys stay, 8 bytes each,
    for a filter that must grow.
    """

    def __init__(self, buckets: int = 1024) -> None:
        self.filter = CuckooFilter(buckets)
        self.keys, self.withdrawn = array("Q"), array("Q")
        self.contents: dict[int, list[list]] = {}

    def _insert(self, key: int) -> None:
        self.keys.append(key)
        if self.filter.insert(key):
            return
        out = Counter(self.withdrawn)
        live = array("Q")
        for k in self.keys:
            if out[k] > 0:
                out[k] -= 1
            else:
                live.append(k)
        self.keys, self.withdrawn = live, array("Q")
        buckets, whole = self.filter.mask + 1, False
        while not whole:
            buckets *= 2
            self.filter = CuckooFilter(buckets)
            whole = all(map(self.filter.insert, self.keys))

    def entry(self, key: int, content: bytes) -> list:
        """The entry of this content, made if it is new: [content, rows, best row]."""
        if key in self.filter:
            for kept in self.contents.get(key, ()):
                if kept[0] == content:
                    return kept
        new = [content, 0, None]
        self.contents.setdefault(key, []).append(new)
        self._insert(key)
        return new

    def _take_out(self, key: int) -> None:
        self.filter.delete(key)
        self.withdrawn.append(key)

    def delete(self, key: int, content: bytes) -> None:
        kept = self.contents.get(key, [])
        for place, one in enumerate(kept):
            if one[0] == content:
                del kept[place]
                if not kept:
                    del self.contents[key]
                self._take_out(key)
                return

    def release(self, key: int) -> list[list]:
        """The live entries of a digest whose rows have all come; without live rows it is deleted."""
        entries = self.contents.pop(key, [])
        for _ in [one for one in entries if not one[1]]:
            self._take_out(key)
        return [one for one in entries if one[1]]


def _norm(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column("text").cast(pa.binary()).to_pylist():
        yield (text or b"").translate(None, BLANKS)


def _better(a: tuple | None, b: tuple | None) -> tuple | None:
    """Of two (code points, doc_id): the longer, then the smaller id; a null id last."""
    if a is None or b is None:
        return a or b
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0)
    return min(a, b, key=rank)


def _lengths(batch: pa.RecordBatch) -> list[int]:
    return pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([hashlib.sha256(x).hexdigest() for x in _norm(batch)], pa.string()),
            ],
            ["doc_id", "text_sha256"],
        )


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal contents of a batch as one row: rows, live rows and the best live row."""
    for batch in batches:
        seen: dict[bytes, list] = {}
        rows = zip(
            _norm(batch), batch.column("doc_id").to_pylist(), _lengths(batch),
            batch.column("gone").to_pylist(), strict=True,
        )
        for content, doc_id, points, gone in rows:
            one = seen.setdefault(content, [0, None])
            if not gone:
                one[0] += 1
                one[1] = _better(one[1], (points, doc_id))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([hashlib.sha256(x).digest() for x in seen], pa.binary()),
                pa.array(list(seen), pa.binary()),
                pa.array([n for n, _ in seen.values()], pa.int64()),
                pa.array([b and b[0] for _, b in seen.values()], pa.int64()),
                pa.array([b and b[1] for _, b in seen.values()], pa.int64()),
            ],
            ["digest", "content", "n", "points", "best"],
        )


def _index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of rows sorted by digest."""
    index, out = DigestIndex(), []

    def part() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in out], pa.string()),
                pa.array([best[1] for _, _, best in out], pa.int64()),
                pa.array([n for _, n, _ in out], pa.int64()),
            ],
            ["text_sha256", "keep_id", "group_size"],
        )

    def close(digest: bytes) -> None:
        out.extend((digest.hex(), n, best) for _, n, best in index.release(_key(digest)))

    current = None
    for batch in batches:
        for digest, content, n, points, best in zip(*batch.columns, strict=True):
            digest, points = digest.as_py(), points.as_py()
            if current is not None and digest != current:
                close(current)
            current = digest
            one = index.entry(_key(digest), content.as_py())
            one[1] += n.as_py()
            one[2] = _better(one[2], None if points is None else (points, best.as_py()))
        if len(out) >= 10_000:
            yield part()
            out.clear()
    if current is not None:
        close(current)
    yield part()


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little")


def exact_dedup(docs: DataFrame, gone: str | None = None) -> DataFrame:
    """Class of every document among texts that are equal but for blanks.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  ``gone`` names a boolean
    column of withdrawn rows: they are deleted from the index and get no ``keep_id``.  Returns one
    row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.  The row
    with the most code points stays, then the smallest ``doc_id``; a null id comes last.
    A null text counts as empty, and empty texts are equal.  Rows that repeat the id that stays
    count as copies, and each of them is marked as kept.
    """
    flag = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", flag.alias("gone"))
    folded = rows.mapInArrow(
        _fold, "digest binary, content binary, n bigint, points bigint, best bigint"
    )
    dealt = folded.repartition(tasks(docs.sparkSession), "digest").sortWithinPartitions("digest")
    classes = dealt.mapInArrow(
        _index, "text_sha256 string, keep_id bigint, group_size bigint"
    )
    each = rows.where(~F.col("gone")).select("doc_id", "text")
    each = each.mapInArrow(_digests, "doc_id bigint, text_sha256 string")
    found = each.join(classes, "text_sha256", "left")
    if gone:
        out = rows.where("gone").select("doc_id", "text").mapInArrow(
            _digests, "doc_id bigint, text_sha256 string"
        )
        found = found.unionByName(out, allowMissingColumns=True)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("group_size").isNotNull()
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
