"""Removal of repeated 100-byte strings by blockwise suffix sorting with a difference cover.

Texts are packed into blocks of a few megabytes.  A suffix matters only up to its first ``LENGTH``
bytes, so sorting is cut off there.

1. Cover sample.  Of each document the positions whose remainder modulo ``PERIOD`` is in a difference
   cover are named: a rank (64-bit name) of the next ``LENGTH - PERIOD + 1`` bytes.  For any two
   suffixes there is an offset below ``PERIOD`` at which both are sampled, so two suffixes that are
   equal over ``LENGTH`` bytes have a shared rank there.  A shuffle of the names alone finds the
   ranks that occur more than once.
2. Suffix buckets.  A suffix none of whose sampled positions has a shared rank is alone and is not
   sorted at all.  The others go to buckets by the least 16-byte hash inside their first ``LENGTH``
   bytes: equal suffixes meet, and neighbours mostly share a bucket, so they travel as one stretch of
   text instead of one record each.  Equal stretches of a block go as one.  At the edges of a passage
   that many documents share, every document has a stretch of its own under the same hash.  Hashes with
   more than ``HOT`` stretches (estimated from a part of the blocks; only the way of the suffixes depends
   on it) are split: of their suffixes, those whose name of all ``LENGTH`` bytes occurs once are alone,
   and each other goes by that name, so no hash ties a bucket to the number of documents.
3. A task takes one bucket at a time: its suffixes are sorted by name in order of their place, ties
   are compared byte by byte, and all but the first of equal ones are marked.
4. Marks go back to the blocks, and the bytes under marked strings are cut out.

A bucket and a block are what a task holds; their sizes do not depend on the amount of text, since the
number of buckets follows ``spark.sql.shuffle.partitions``.  A text longer than a block makes a block
of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import short_shuffles, tasks
from cardledger.session import scratch_path

LENGTH = 100
PERIOD = 57
#: Remainders such that every difference modulo PERIOD is one of two of them.
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
SAMPLED = LENGTH - PERIOD + 1
GRAM = 16
BLOCK_BYTES = 2 << 20
BUCKETS_A_TASK = 4
#: Stretches under one hash beyond which its suffixes go by their own names, and the part of the blocks
#: (one in so many) that is counted.
HOT = 20_000
COUNTED = 4

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(57).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashes:
    """Polynomial hashes modulo 2^64 of all substrings of some bytes."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[begin]) * self.back[begin])

    def windows(self, n: int) -> np.ndarray:
        """Of the ``n`` bytes from each position on."""
        last = max(0, len(self.sums) - n)
        return _mixed((self.sums[n:][:last] - self.sums[:last]) * self.back[:last])


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` consecutive ones."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:]) if len(h) > size else h[:0]
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if len(h) > rest else h[:0]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    change = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return change[::2], change[1::2]


def _covered(size: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in a stretch."""
    edge = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edge, begins, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


class Block:
    """Texts one after the other, in the order of their ids."""

    def __init__(self, row: dict) -> None:
        self.number: int = row["block"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.begins = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        self.data = np.frombuffer(row["data"], np.uint8)

    def within(self, length: int) -> np.ndarray:
        """Which positions have ``length`` bytes left in their text."""
        keep = self.ends - self.begins >= length
        return _covered(len(self.data), self.begins[keep], self.ends[keep] - length + 1)

    def sampled(self) -> np.ndarray:
        """Positions of the cover sample."""
        place = np.arange(len(self.data)) - np.repeat(self.begins, self.ends - self.begins)
        member = np.zeros(PERIOD, dtype=bool)
        member[list(COVER)] = True
        return np.flatnonzero(member[place % PERIOD] & self.within(SAMPLED))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = 0
    texts: list[tuple[bool, int, bytes]] = []

    def block() -> pa.RecordBatch:
        texts.sort(key=lambda x: x[:2])
        number = (TaskContext.get().partitionId() << 32) + count
        ends = np.cumsum([len(t) for *_, t in texts], dtype=np.int64)
        return pa.RecordBatch.from_pylist(
            [
                {
                    "block": number,
                    "ids": np.array([i for _, i, _ in texts], np.int64).tobytes(),
                    "nulls": np.array([not known for known, _, _ in texts]).tobytes(),
                    "ends": ends.tobytes(),
                    "data": b"".join(t for *_, t in texts),
                }
            ]
        )

    size = 0
    for batch in batches:
        for doc_id, text in zip(
            batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True
        ):
            texts.append((doc_id is not None, doc_id or 0, text or b""))
            size += len(texts[-1][2])
            if size >= BLOCK_BYTES:
                yield block()
                count, size, texts = count + 1, 0, []
    if texts:
        yield block()


_PACKED = "block bigint, ids binary, nulls binary, ends binary, data binary"


def _name_sender(buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block's names once, by bucket."""
        for row in _rows(batches):
            block = Block(row)
            at = block.sampled()
            yield _dealt_names(block, Hashes(block.data).of(at, at + SAMPLED), buckets)

    return send


def _dealt_names(block: Block, names: np.ndarray, buckets: int) -> pa.RecordBatch:
    names = np.unique(names)
    bucket = (names >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    names = names[order]
    out = [
        {"bucket": b, "block": block.number, "names": names[s:e].tobytes()}
        for b, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
        if e > s
    ]
    return pa.RecordBatch.from_pylist(
        out, pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("names", pa.binary())])
    )


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one bucket after the other; the partition is sorted by bucket."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["bucket"] != row["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _shared_names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block's names those that other blocks have too."""
    for rows in _by_bucket(batches):
        names = [np.frombuffer(r["names"], np.uint64) for r in rows]
        every = np.sort(np.concatenate(names))
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        out = [
            {"block": r["block"], "names": own.tobytes()}
            for r, n in zip(rows, names, strict=True)
            if len(own := n[_among(n, shared)])
        ]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("block", pa.int64()), ("names", pa.binary())]))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _repeated(names: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Names that are shared with other blocks or occur twice in their own."""
    order = np.sort(names)
    return _among(names, shared) | _among(names, np.unique(order[1:][order[1:] == order[:-1]]))


def _live(block: Block, hashes: Hashes, shared: np.ndarray) -> np.ndarray:
    """Suffixes with a shared rank at one of their sampled positions."""
    at = block.sampled()
    at = at[_repeated(hashes.of(at, at + SAMPLED), shared)]
    document = np.searchsorted(block.ends, at, side="right")
    begins = np.maximum(at - PERIOD + 1, block.begins[document])
    return _covered(len(block.data), begins, at + 1) & block.within(LENGTH)


_SEGMENT = np.dtype([("id", "<i8"), ("known", "<i8"), ("block", "<i8"), ("doc", "<i8"), ("begin", "<i8"), ("n", "<i8")])
_MARK = np.dtype([("begin", "<i8"), ("end", "<i8")])


def _received(names: list[bytes] | None) -> np.ndarray:
    return np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in names or []] or [np.empty(0, np.uint64)]))


def _stretches(
    block: Block, hashes: Hashes, live: np.ndarray, hot: np.ndarray, names: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends (of the starts) and bucket keys of runs of live suffixes with one key.  Of those
    under a hot key, each that has a repeated name is a run with its name as the key."""
    least = _least(hashes.windows(GRAM), LENGTH - GRAM + 1)
    live = live[: len(least)]
    at = np.flatnonzero(live & _among(least, hot))
    own = hashes.of(at, at + LENGTH)
    split = np.zeros(len(least), dtype=bool)
    split[at] = True
    live[at] = _repeated(own, names)
    least[at] = own
    document = np.repeat(np.arange(len(block.ends)), block.ends - block.begins)[: len(least)]
    change = np.ones(len(least), dtype=bool)
    change[1:] = (least[1:] != least[:-1]) | (document[1:] != document[:-1]) | (live[1:] != live[:-1])
    change[1:] |= split[1:] | split[:-1]
    begins = np.flatnonzero(change)
    ends = np.concatenate((begins[1:], [len(least)]))
    keep = live[begins]
    return begins[keep], ends[keep], least[begins[keep]]


def _count_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different stretches by key, of each block."""
    none = np.empty(0, np.uint64)
    for row in _rows(batches):
        block = Block(row)
        hashes = Hashes(block.data)
        live = _live(block, hashes, _received(row["names"]))
        if live.any():
            begins, ends, key = _stretches(block, hashes, live, none, none)
            _, first = np.unique(hashes.of(begins, ends + LENGTH - 1), return_index=True)
            keys, n = np.unique(key[first], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _hot_name_sender(buckets: int, hot: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block's names of the suffixes under hot keys, by bucket.  Needs no shared ranks, so
        that texts are not shuffled for it: a repeated name is live."""
        for row in _rows(batches):
            block = Block(row)
            hashes = Hashes(block.data)
            least = _least(hashes.windows(GRAM), LENGTH - GRAM + 1)
            at = np.flatnonzero(block.within(LENGTH)[: len(least)] & _among(least, hot))
            yield _dealt_names(block, hashes.of(at, at + LENGTH), buckets)

    return send


def _segment_sender(
    buckets: int, hot: np.ndarray
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stretches of live suffixes by bucket.  Marks that a block can set itself go along in rows of
    bucket numbers from ``buckets`` on, which have no text to sort."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for row in _rows(batches):
            block = Block(row)
            hashes = Hashes(block.data)
            live = _live(block, hashes, _received(row["names"]))
            out: list[dict] = []
            if live.any():
                begins, ends, key = _stretches(block, hashes, live, hot, _received(row.get("hot_names")))
                # Equal stretches go once: the first stands for all, and the others are marked.
                whole = hashes.of(begins, ends + LENGTH - 1)
                _, first, same = np.unique(whole, return_index=True, return_inverse=True)
                first = first[same]
                raw = block.data.tobytes()
                again = np.flatnonzero(first != np.arange(len(first)))
                equal = np.array(
                    [raw[begins[i] : ends[i] + LENGTH - 1] == raw[begins[first[i]] : ends[first[i]] + LENGTH - 1] for i in again.tolist()],
                    dtype=bool,
                )
                marked = again[equal]
                if len(marked):
                    marks = np.zeros(len(marked), _MARK)
                    marks["begin"], marks["end"] = begins[marked], ends[marked]
                    out.append({"bucket": buckets + block.number % buckets, "block": block.number, "marks": marks.tobytes(), "segments": None})
                sent = np.setdiff1d(np.arange(len(begins)), marked)
                bucket = ((key[sent] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                sent, bucket = sent[order], bucket[order]
                document = np.searchsorted(block.ends, begins[sent], side="right")
                nulls = np.frombuffer(row["nulls"], bool)
                records = np.zeros(len(sent), _SEGMENT)
                records["id"], records["known"] = block.ids[document], ~nulls[document]
                records["block"], records["doc"], records["begin"] = block.number, document, begins[sent]
                records["n"] = ends[sent] - begins[sent]
                for s, e in zip(*_same(bucket), strict=True):
                    text = b"".join(
                        raw[a : b + LENGTH - 1] for a, b in zip(begins[sent[s:e]].tolist(), ends[sent[s:e]].tolist(), strict=True)
                    )
                    packed = packer.compress(records[s:e].tobytes() + text)
                    size = np.int64(e - s).tobytes()
                    out.append({"bucket": int(bucket[s]), "block": None, "marks": None, "segments": size + packed})
            yield pa.RecordBatch.from_pylist(out, _SENT)

    return send


_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("marks", pa.binary()), ("segments", pa.binary())])


def _same(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of stretches of equal values."""
    begins = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, int)
    return begins, np.concatenate((begins[1:], [len(values)])).astype(int) if len(values) else begins


def _later(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which suffixes equal an earlier one over ``LENGTH`` bytes."""
    hashes = Hashes(text)
    names = hashes.of(starts, starts + LENGTH)
    _, first, same = np.unique(names, return_index=True, return_inverse=True)
    first = first[same]
    later = first != np.arange(len(starts))
    # Where a suffix and its first go on from the pair before, one more byte is to be compared.
    goes_on = np.zeros(len(starts), dtype=bool)
    goes_on[1:] = later[1:] & later[:-1] & (starts[1:] == starts[:-1] + 1) & (first[1:] == first[:-1] + 1)
    goes_on[1:] &= starts[first[1:]] == starts[first[:-1]] + 1
    mine, its = starts[later], starts[first[later]]
    right = bool((text[mine + LENGTH - 1] == text[its + LENGTH - 1]).all())
    heads = np.flatnonzero(later & ~goes_on)
    step = np.arange(LENGTH)
    for at in range(0, len(heads), 10_000):
        part = heads[at : at + 10_000]
        right &= bool((text[starts[part][:, None] + step] == text[starts[first[part]][:, None] + step]).all())
    if not right:  # two strings with one name: compare the strings themselves
        raw, seen = text.tobytes(), {}
        held = [seen.setdefault(raw[s : s + LENGTH], i) for i, s in enumerate(starts.tolist())]
        later = np.array(held) != np.arange(len(starts))
    return later


def _sort_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks (block, begin, end) of suffixes that are not the first of their kind."""
    opener = zstandard.ZstdDecompressor()
    schema = pa.schema([("block", pa.int64()), ("marks", pa.binary())])
    for rows in _by_bucket(batches):
        own = [{"block": r["block"], "marks": r["marks"]} for r in rows if r["marks"] is not None]
        parts, texts = [], []
        for r in rows:
            if r["segments"] is not None:
                n = int(np.frombuffer(r["segments"][:8], np.int64)[0]) * _SEGMENT.itemsize
                plain = opener.decompress(r["segments"][8:])
                parts.append(np.frombuffer(plain[:n], _SEGMENT))
                texts.append(plain[n:])
        if parts:
            segments, text = np.concatenate(parts), np.frombuffer(b"".join(texts), np.uint8)
            sizes = segments["n"] + LENGTH - 1
            offsets = np.cumsum(sizes) - sizes
            order = np.lexsort([segments[c] for c in ("begin", "doc", "block", "id", "known")])
            segments, offsets = segments[order], offsets[order]
            owner = np.repeat(np.arange(len(segments)), segments["n"])
            step = np.arange(len(owner)) - np.repeat(np.cumsum(segments["n"]) - segments["n"], segments["n"])
            later = _later(text, offsets[owner] + step)
            # Runs of marks end with their stretch.
            edge = np.concatenate(([True], owner[1:] != owner[:-1])) | np.concatenate(([True], later[1:] != later[:-1]))
            heads = np.flatnonzero(edge)
            tails = np.concatenate((heads[1:], [len(owner)]))
            heads, tails = heads[later[heads]], tails[later[heads]]
            marks = np.zeros(len(heads), _MARK)
            marks["begin"] = segments["begin"][owner[heads]] + step[heads]
            marks["end"] = marks["begin"] + tails - heads
            block = segments["block"][owner[heads]]
            by = np.argsort(block, kind="stable")
            marks, block = marks[by], block[by]
            own += [
                {"block": int(block[s]), "marks": marks[s:e].tobytes()} for s, e in zip(*_same(block), strict=True)
            ]
        yield pa.RecordBatch.from_pylist(own, schema)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        block = Block(row)
        marks = np.concatenate([np.frombuffer(x, _MARK) for x in row["marks"] or []] or [np.empty(0, _MARK)])
        gone = _covered(len(block.data), marks["begin"], marks["end"] + LENGTH - 1)
        nulls = np.frombuffer(row["nulls"], bool)
        out = []
        for doc_id, null, a, b in zip(block.ids.tolist(), nulls.tolist(), block.begins.tolist(), block.ends.tolist(), strict=True):
            own = gone[a:b]
            out.append(
                {
                    "doc_id": None if null else doc_id,
                    "n_bytes": b - a,
                    "n_removed": int(own.sum()),
                    "n_spans": len(_runs(own)[0]),
                    "kept": block.data[a:b][~own].tobytes(),
                }
            )
        for r in out:
            r["kept_sha256"] = hashlib.sha256(r["kept"]).hexdigest()
        yield pa.RecordBatch.from_pylist(out, _CUT)


_CUT = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    + [("kept", pa.binary()), ("kept_sha256", pa.string())]
)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written with close packing, and read back."""
    path = scratch_path(df.sparkSession, name)
    with short_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").option("parquet.page.size.row.check.min", "1").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Texts without the bytes of strings of 100 bytes that also start earlier.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  Earlier is a smaller
    ``doc_id``, or an earlier byte of the same document; a null id is smallest, and of rows that
    repeat an id one is taken as the earlier.  Strings are judged on the input, overlaps count, and
    none reaches over the end of a document.  Returns one row per input row: ``doc_id``,
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (bytes that are left)
    and ``kept_sha256``.  A null text is empty; texts below 100 bytes stay as they are.  ``hot``
    bounds the stretches that go to a bucket by one hash; it does not change the result.
    """
    spark = docs.sparkSession
    n = tasks(spark)
    buckets = n * BUCKETS_A_TASK
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    packed = _stored(rows.mapInArrow(_pack, _PACKED), "blocks")
    names = packed.mapInArrow(_name_sender(buckets), "bucket int, block bigint, names binary")
    names = names.repartition(n, "bucket").sortWithinPartitions("bucket")
    shared = _stored(names.mapInArrow(_shared_names, "block bigint, names binary"), "ranks")

    shared = shared.groupBy("block").agg(F.collect_list("names").alias("names"))
    blocks = packed.join(shared, "block", "left")
    counted = packed.where(F.pmod(F.xxhash64("block"), F.lit(COUNTED)) == 0).join(shared, "block", "left")
    counted = counted.mapInArrow(_count_keys, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    with short_shuffles(spark):
        keys = [r["key"] for r in counted.where(F.col("n") * COUNTED > hot).select("key").collect()]
    split = np.sort(np.array(keys, np.int64).view(np.uint64))
    if keys:
        names = packed.mapInArrow(_hot_name_sender(buckets, split), "bucket int, block bigint, names binary")
        names = names.repartition(n, "bucket").sortWithinPartitions("bucket")
        names = _stored(names.mapInArrow(_shared_names, "block bigint, names binary"), "hot_ranks")
        names = names.groupBy("block").agg(F.collect_list("names").alias("hot_names"))
        blocks = blocks.join(names, "block", "left")
    sent = blocks.mapInArrow(
        _segment_sender(buckets, split), "bucket bigint, block bigint, marks binary, segments binary"
    )
    sent = sent.repartition(n, "bucket").sortWithinPartitions("bucket")
    marks = _stored(sent.mapInArrow(_sort_buckets, "block bigint, marks binary"), "marks")

    marks = marks.groupBy("block").agg(F.collect_list("marks").alias("marks"))
    return packed.join(marks, "block", "left").mapInArrow(
        _cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"
    )
