"""SentencePiece models on the tokenizers library.

The model's protobuf is read here; the normaliser, the metaspace marker, the pieces with their
scores (unigram) or the merges that their scores imply (BPE) and the byte fallback are built anew as
a ``Tokenizer``, which encodes batches on several threads.  Where no piece goes on into a next word,
the ids of short words are remembered.  Every text is also encoded whole by the
sentencepiece library and decoded again, and both outcomes are columns of the result.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
#: Texts whose ids are held as Python numbers at a time.
ROWS = 100
MARK = "▁"
# Fixed values of the model format: kinds of piece and of model.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Characters encoded at a time; a longer text is cut between words where the pieces allow it.
_CHUNK = 1 << 18
#: Words whose ids are remembered, bytes of the longest of them, and words encoded as one text.
_WORDS, _WORD, _STRETCH = 1 << 18, 15, 256


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} is not part of a model file")
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True

    @staticmethod
    def parse(data: bytes) -> PieceModel:
        model = PieceModel()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                model.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                model.kind = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
                model.unk_id = trainer.get(40, 0)
            elif number == 3:
                norm = dict(_fields(value))
                model.charsmap = norm.get(2, b"")
                model.dummy_prefix = bool(norm.get(3, 1))
                model.trim_spaces = bool(norm.get(4, 1))
                model.escape_spaces = bool(norm.get(5, 1))
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models can be rebuilt")
        return model

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces in the order of the scores of what they make."""
        ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = []
        for piece, whole in ids.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in ids and right in ids:
                    found.append((-self.pieces[whole][1], whole, ids[left], ids[right], left, right))
        return [(left, right) for *_, left, right in sorted(found)]

    def words_apart(self) -> bool:
        """Whether no piece goes on after the end of a word, so that texts can be cut there."""
        return self.escape_spaces and not any(MARK in p.lstrip(MARK) for p, _, _ in self.pieces)


class KnownWords:
    """Ids of short words.  A word has one place, by its bytes and length; a later word takes it over."""

    def __init__(self) -> None:
        # A key is a word's bytes and its length; no word has the length of the free places.  A word of n
        # bytes and its mark have at most n + 1 pieces.
        self.keys = np.full((_WORDS, 2), -1, np.int64)
        self.ids = np.zeros((_WORDS, _WORD + 1), np.int32)
        self.sizes = np.zeros(_WORDS, np.int64)
        self.owner = np.zeros(_WORDS, np.int64)
        self.shown = np.array([[255] * n + [0] * (_WORD + 1 - n) for n in range(_WORD + 1)], np.uint8)

    def find(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys and places of words, and which are short.  ``data`` goes on for 17 bytes after the last."""
        short = sizes <= _WORD
        counted = np.where(short, sizes, 0)
        keys = sliding_window_view(data, _WORD + 1)[starts] & self.shown[counted]
        keys[:, _WORD] = counted
        keys = keys.view(np.int64)
        mixed = keys.view(np.uint64) * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
        mixed = mixed[:, 0] ^ (mixed[:, 1] >> np.uint64(7))
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return keys, (mixed >> np.uint64(40)).astype(np.int64) % len(self.keys), short

    def holds(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether the places are those words'."""
        return (self.keys[places] == keys).all(axis=1)


class PieceTokenizer:
    """Encoder and decoder of a model, rebuilt."""

    def __init__(self, data: bytes) -> None:
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        model = self.model = PieceModel.parse(data)
        if model.kind == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
            core = models.BPE(
                vocab=vocab, merges=model.merges(), unk_token=model.pieces[model.unk_id][0], fuse_unk=True,
                byte_fallback=model.byte_fallback,
            )
        else:
            core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
        self.core = Tokenizer(core)
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.trim_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if model.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if model.escape_spaces else " "))
        if model.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        # Spaces to marks alone, the common case, is a replacement of characters.
        plain = not model.charsmap and not model.trim_spaces and model.escape_spaces
        self.normalizer = None if plain else normalizers.Sequence(steps)
        back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        self.core.decoder = decoders.Sequence(back + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix)
        self.apart = model.words_apart()
        # A unigram's scores are sums over the whole text, so ties could come out otherwise by words.
        marked = (MARK, NORMAL) in ((p, kind) for p, _, kind in model.pieces)
        marked = marked and not model.pieces[model.unk_id][0].startswith(MARK)
        self.known = KnownWords() if plain and model.dummy_prefix and self.apart and model.kind == BPE and marked else None
        self.opens = np.array([p.startswith(MARK) for p, _, _ in model.pieces])
        self.marks = np.array([p != "" and not p.strip(MARK) for p, _, _ in model.pieces])
        spelled = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in model.pieces]
        self.spelled = pa.array(spelled, pa.large_binary())

    def _normal(self, text: str) -> str:
        if self.normalizer is not None:
            return self.normalizer.normalize_str(text)
        return MARK * self.model.dummy_prefix + text.replace(" ", MARK)

    def _cut(self, text: str) -> list[str]:
        """A normalised text in stretches that no piece reaches across."""
        out, begin = [], 0
        while self.apart and len(text) - begin > _CHUNK:
            at = begin + _CHUNK
            while at < len(text) and not (text[at] == MARK and text[at - 1] != MARK):
                at += 1
            out.append(text[begin:at])
            begin = at
        return [*out, text[begin:]]

    def _run(self, parts: list[str]) -> Iterator[list[int]]:
        """Piece ids of normalised texts."""
        begin = 0
        while begin < len(parts):
            end, size = begin, 0
            while end < len(parts) and (end == begin or size + len(parts[end]) <= _CHUNK):
                size += len(parts[end])
                end += 1
            for one in self.core.encode_batch_fast(parts[begin:end], add_special_tokens=False):
                yield one.ids
            begin = end

    def _encode_whole(self, texts: list[str]) -> list[list[int]]:
        """Piece ids of each normalised text."""
        parts, owners = [], []
        for i, text in enumerate(texts):
            cut = self._cut(text)
            parts += cut
            owners += [i] * len(cut)
        out: list[list[int]] = [[] for _ in texts]
        for owner, ids in zip(owners, self._run(parts), strict=True):
            out[owner] = out[owner] + ids if out[owner] else ids
        return out

    def _encode_words(self, texts: list[str]) -> list[list[int]]:
        """Piece ids of each text by its words, where texts end within a word and hold no mark.

        A word goes from a space that follows another character (or the start of a text, where a space
        is put) to the next.  Words not known are encoded many as one text: there, a word begins with a
        piece that opens with a mark and follows a piece of more than marks."""
        known = self.known
        coded = [b" " + text.encode() for text in texts]
        data = np.frombuffer(b"".join(coded) + bytes(_WORD + 2), np.uint8)
        blank = data == 32
        blank[1:] &= ~blank[:-1].copy()
        bounds = np.append(np.flatnonzero(blank), len(data) - _WORD - 2)
        starts, sizes = bounds[:-1], np.diff(bounds)
        keys, places, short = known.find(data, starts + 1, sizes - 1)
        found = short & known.holds(keys, places)
        missed = np.flatnonzero(~found)
        # Of equal short words, the last in its place is encoded.
        owner = known.owner
        owner[places[missed]] = missed
        heir = owner[places[missed]]
        same = short[missed] & (heir != missed) & (keys[heir] == keys[missed]).all(axis=1)
        coding = missed[~same]
        chosen = np.zeros(len(starts), bool)
        chosen[coding] = True
        rest = data[: bounds[-1]][np.repeat(chosen, sizes)].tobytes()
        cuts = np.concatenate(([0], np.cumsum(sizes[coding])))
        cuts = [*cuts[:-1:_STRETCH].tolist(), int(cuts[-1])]
        parts = [rest[a:b].decode().replace(" ", MARK) for a, b in pairwise(cuts)]
        made = np.concatenate([np.zeros(0, np.int32), *(np.array(x, np.int32) for x in self._run(parts))])
        begins = self.opens[made]
        begins[1:] &= ~self.marks[made[:-1]]
        edges = np.append(np.flatnonzero(begins), len(made))
        lengths = np.diff(edges)
        # What was known is read before its place may be taken over.
        counts = np.zeros(len(starts), np.int64)
        counts[coding] = lengths
        rows = np.zeros((len(starts), _WORD + 1), np.int32)
        rows[found] = known.ids[places[found]]
        counts[found] = known.sizes[places[found]]
        fits = short[coding]
        column = np.arange(_WORD + 1)
        filled = column < lengths[fits][:, None]
        fresh = np.zeros(filled.shape, np.int32)
        fresh[filled] = made[np.repeat(fits, lengths)]
        rows[coding[fits]] = fresh
        rows[missed[same]] = rows[heir[same]]
        counts[missed[same]] = counts[heir[same]]
        kept = coding[fits]
        kept = kept[owner[places[kept]] == kept]
        known.keys[places[kept]], known.ids[places[kept]], known.sizes[places[kept]] = keys[kept], rows[kept], counts[kept]
        # Long words stand in ``made`` alone.
        flat = np.empty(counts.sum(), np.int32)
        brief = np.repeat(short, counts)
        flat[brief] = rows[column < np.where(short, counts, 0)[:, None]]
        flat[~brief] = made[np.repeat(~fits, lengths)]
        upto = np.concatenate(([0], np.cumsum(counts)))
        ends = np.searchsorted(starts, np.cumsum([0, *map(len, coded)]))
        return [flat[a:b].tolist() for a, b in pairwise(upto[ends].tolist())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Piece ids of each text; none for an empty one."""
        out: list[list[int]] = [[] for _ in texts]
        whole, groups, size = [], [], _CHUNK
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.known is None or len(text) > _CHUNK or text.endswith(" ") or MARK in text:
                whole.append(i)
                continue
            if size + len(text) > _CHUNK:
                groups.append([])
                size = 0
            groups[-1].append(i)
            size += len(text)
        for owners, ids in zip(groups, (self._encode_words([texts[i] for i in x]) for x in groups), strict=True):
            for i, one in zip(owners, ids, strict=True):
                out[i] = one
        for i, one in zip(whole, self._encode_whole([self._normal(texts[i]) for i in whole]), strict=True):
            out[i] = one
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.core.decode_batch(ids, skip_special_tokens=False)

    def spells(self, flat: np.ndarray, ends: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether the ids of each text, one after another in ``flat``, decode to it: the same bytes,
        without making texts of them."""
        made = self.spelled.take(pa.array(flat))
        cuts = np.concatenate(([0], np.cumsum(pc.binary_length(made).to_numpy())))[ends].tolist()
        data = made.buffers()[2].to_pybytes() if cuts[-1] else b""
        out = []
        for (a, b), text in zip(pairwise(cuts), texts, strict=True):
            skip = self.model.dummy_prefix and data[a : min(a + 1, b)] == b" "
            out.append(data[a + skip : b] == text.encode())
        return out


@lru_cache(maxsize=1)
def _tokenizers(data: bytes, threads: int) -> tuple:
    """The rebuilt tokenizer and the library's, made once in a worker."""
    os.environ |= {"TOKENIZERS_PARALLELISM": "true", "RAYON_NUM_THREADS": str(threads)}
    import sentencepiece

    return PieceTokenizer(data), sentencepiece.SentencePieceProcessor(model_proto=data)


def _encoder(data: bytes, threads: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rebuilt, peer = _tokenizers(data, threads)
        fallback = np.array([kind == BYTE for _, _, kind in rebuilt.model.pieces])
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [x or "" for x in part.column("text").to_pylist()]
                ids = rebuilt.encode(texts)
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.fromiter(chain.from_iterable(ids), "<i4", ends[-1])
                spelled = np.concatenate(([0], np.cumsum(fallback[flat])))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.array(np.diff(spelled[ends]), pa.int64()),
                        pa.array(rebuilt.spells(flat, ends, texts)),
                        pa.array([a == b for a, b in zip(peer.encode(texts, num_threads=1), ids, strict=True)]),
                        pa.array([hashlib.sha256(flat[a:b]).hexdigest() for a, b in pairwise(ends)], pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                    ],
                    ["doc_id", "n_tokens", "n_byte_tokens", "round_trip", "parity", "ids_sha256", "token_ids"],
                )

    return encode


def piece_tokens(docs: DataFrame, model_path: str = MODEL, threads: int = THREADS) -> DataFrame:
    """Piece ids of every text, checked against the sentencepiece library and by decoding.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  The model file is read on
    the driver and sent along.  Returns one row per input row: ``doc_id``, ``n_tokens``,
    ``n_byte_tokens``, ``round_trip`` (decoding gives the text back), ``parity`` (the sentencepiece
    library gives the same ids), ``ids_sha256`` (of the ids as little-endian 32-bit integers),
    ``token_ids``.  A null or empty text has no ids and passes both checks.  Repeated rows get equal
    results.  Models that change texts (other normalisers, trimmed spaces) show ``round_trip`` false
    for the texts they change.
    """
    with open(model_path, "rb") as file:
        data = file.read()
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(
        _encoder(data, threads),
        "doc_id bigint, n_tokens bigint, n_byte_tokens bigint, round_trip boolean, parity boolean, "
        "ids_sha256 string, token_ids array<int>",
    )
