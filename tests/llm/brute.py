"""Plain versions of the text operators, and documents with the odd cases."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LEAK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
PROSE = "the quick brown fox jumps over the lazy dog while nobody looks at all and the sun sets slowly "


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


#: (doc_id, text, lang): null and empty texts, blanks, copies, near copies, long texts, other alphabets.
DOCS = [
    (5, PROSE * 3, "en"),
    (3, PROSE * 3, "en"),
    (4, PROSE.upper() * 3, "en"),
    (7, None, "en"),
    (8, "", None),
    (9, " \t\n\x0b\x0c\r ", "fr"),
    (10, "!!! --- 12 34", "de"),
    (11, "Été À la plage, ÇA VA " * 30, "fr"),
    (12, "x" + LEAK.title() + " Über straße " + LEAK, "de"),
    (13, LEAK + "\n" + LEAK + "\n" + LEAK, None),
    (14, "a\nb\nc\nd\ne\nf\ng\nh\n" * 40, "en"),
    (15, "zz\na\nb\nc\nd\ne\nf\ng\nh\n" * 40, "en"),
    (16, "licensed Under The MIT License, apache-license version 2 or CC-BY-NC cc by nc", "en"),
    (17, "w" * 300 + "q" * 300, "en"),
    (18, PROSE.replace(" ", "  ") * 3, "en"),
    (19, "日本語 のテキスト 𝔘nicode", "ja"),
    (20, (PROSE * 900) + "end", "en"),
    (21, "only three words", "en"),
    (-2, "only  three words", "en"),
    (22, None, None),
    (None, "no id at all " * 12, "en"),
]
#: Names that the operators use inside.
EXTRA = "mark string, ws string, digest string, fp string, hash string, block string, score string, n string"


def frame(spark, rows=DOCS, repeat: bool = False):
    """Documents with further columns whose names clash with inner ones."""
    rows = [*rows, *([(5, PROSE * 3, "en")] if repeat else [])]
    filled = [(*r, *["same"] * 8) for r in rows]
    return spark.createDataFrame(filled, f"doc_id bigint, text string, lang string, {EXTRA}")


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


def exact(rows) -> dict:
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups: dict[str, list] = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    return {
        i: (min(groups[norm(t)])[3], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest())
        for i, t, *_ in rows
    }


def repeats(rows) -> dict:
    seen, out = set(), {}
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(b[s : s + 100])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(b), sum(gone), spans, kept)
    return out


def leaks(rows, items, window: int = 10) -> dict:
    spans: dict[tuple, set] = {}
    for item, text in items:
        ws = words(text)
        m = min(len(ws), window)
        for s in range(len(ws) - m + 1 if m else 0):
            spans.setdefault(tuple(ws[s : s + m]), set()).add(item)
    out = {}
    for i, text, *_ in rows:
        ws, hit, found = words(text), set(), set()
        for m in {len(x) for x in spans}:
            for s in range(len(ws) - m + 1):
                if tuple(ws[s : s + m]) in spans:
                    hit |= set(range(s, s + m))
                    found |= spans[tuple(ws[s : s + m])]
        out[i] = (len(ws), len(hit), sorted(str(x) for x in found if x is not None))
    return out


def simhash(text: str | None) -> int:
    ws = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)] or [" ".join(ws)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def near(fps: dict) -> dict:
    """Least id within reach, over links of at most 4 bits, by a walk over all pairs."""
    out: dict = {}
    for start in sorted(fps, key=lambda x: (x is None, x or 0)):
        if start in out:
            continue
        queue = [start]
        while queue:
            at = queue.pop()
            if at not in out:
                out[at] = start
                queue += [x for x in fps if x not in out and (fps[x] ^ fps[at]).bit_count() <= 4]
    return out


def licenses(rows, phrases, templates, threshold, stride) -> dict:
    known = [(a, b.split(), True) for a, b in phrases] + [(a, b.split(), False) for a, b in templates]
    out = {}
    for i, text, *_ in rows:
        ws = words(text)
        base = [
            (s, label) for label, p, is_phrase in known if is_phrase
            for s in range(len(ws)) if ws[s : s + len(p)] == p
        ]
        labels, best = set(), 0.0
        for s in range(0, len(ws), stride):
            held = set(ws[s : s + 2 * stride])
            for label, p, _ in known:
                share = len(held & set(p)) / len(set(p))
                if share >= threshold:
                    labels.add(label)
                    best = max(best, share)
        at = [s for s, _ in base]
        out[i] = (
            len(ws), len(base), min(at, default=None), max(at, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), best,
        )
    return out


def chunks(text: str | None) -> list[str]:
    lines = (text or "").split("\n")
    h = [hashlib.md5(x.encode()).hexdigest() for x in lines]
    out, held = [], []
    for i, line in enumerate(lines):
        held.append(line)
        rolled = "".join(h[max(0, i - 2) : i + 1])
        if hashlib.md5(rolled.encode()).hexdigest()[0] in "0123" or i == len(lines) - 1:
            out.append(held)
            held = []
    return out


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def packing_gap(rows, shards, shard_of):
    """How far a packing (doc_id -> shard) is from the plain one, replayed: groups of equal texts, largest
    first, each go to the shard whose residual capacity has the greatest weighted dot product with the
    group; first the large ones, then the others into shares of what is left.  The greatest shortfall of
    a chosen shard's product; 0 but for rounding if every choice is the plain one."""
    groups: dict[str, list] = {}
    for doc_id, text, _ in rows:
        groups.setdefault(text or "", []).append(doc_id)
    vectors = {t: (len(g) * (len(t.encode()) + 8), len(g) * len(t.split()), len(g)) for t, g in groups.items()}
    fair = [max(1.0, sum(v[k] for v in vectors.values()) / shards) for k in range(3)]
    units = {t: [x / f for x, f in zip(v, fair)] for t, v in vectors.items()}
    assert max(max(u) for u in units.values()) <= 1  # no group is split
    order = sorted(units, key=lambda t: (-max(units[t]), hashlib.sha256(t.encode()).digest()))
    large = [t for t in order if max(units[t]) > 1 / 256]
    small = [t for t in order if max(units[t]) <= 1 / 256]
    room, gap = [[1.0] * 3 for _ in range(shards)], [0.0]

    def place(names):
        for t in names:
            scores = [r[0] * units[t][0] * 16 + r[1] * units[t][1] + r[2] * units[t][2] for r in room]
            (own,) = {shard_of[i] for i in groups[t]}
            gap.append(max(scores) - scores[own])
            room[own] = [a - b for a, b in zip(room[own], units[t])]

    place(large)
    left = [max(0.0, sum(max(r[k], 0.0) for r in room)) or 1e-12 for k in range(3)]
    wanted = [sum(units[t][k] for t in small) for k in range(3)]
    room[:] = [[max(r[k], 0.0) / left[k] * wanted[k] for k in range(3)] for r in room]
    place(small)
    return max(gap)
