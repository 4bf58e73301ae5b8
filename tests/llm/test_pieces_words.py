"""Ids of short words are remembered; what stands in a text around them, and which words share a place, is no matter."""

import random

import pytest
import sentencepiece

from cardledger.llm import pieces

with open(pieces.MODEL, "rb") as file:
    MODEL = file.read()


def _counting(rebuilt):
    """Normalised texts that reach the tokenizers library."""
    seen, run = [], rebuilt._run

    def counting(parts):
        seen.extend(parts)
        return run(parts)

    rebuilt._run = counting
    return seen


def test_known_words_are_not_encoded_again():
    rebuilt = pieces.PieceTokenizer(MODEL)
    seen = _counting(rebuilt)
    first = rebuilt.encode(["the word and the other word", "another word"])
    assert "".join(seen).count("▁word") == 1
    seen.clear()
    assert rebuilt.encode(["the word and the other word", "another word"]) == first
    assert "".join(seen) == ""
    rebuilt.encode(["the incomprehensibilities word"])
    assert "".join(seen) == "▁incomprehensibilities"


def test_tokenizers_are_made_once_in_a_worker():
    assert pieces._tokenizers(MODEL, 1) is pieces._tokenizers(bytes(bytearray(MODEL)), 1)


@pytest.mark.parametrize("places", [1, 5, 1 << 18])
@pytest.mark.parametrize("stretch", [1, 3, 256])
def test_words_give_the_library_s_ids(places, stretch, monkeypatch):
    monkeypatch.setattr(pieces, "_WORDS", places)
    monkeypatch.setattr(pieces, "_STRETCH", stretch)
    rebuilt = pieces.PieceTokenizer(MODEL)
    peer = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    parts = ["the", "word", " ", "  ", "   ", "\n", "\t", "\x00", "a\x00", "a", "é", "日本語", "𝔘", "x" * 15, "x" * 16, "é" * 8]
    parts += [".", ",", "▁", " ", "\x01" * 15, "\x01" * 14, "antidisestablishment", "<s>", "<0x41>", "0", "aa", "\x0f"]
    rng = random.Random(7)
    for _ in range(60):
        texts = ["".join(rng.choices(parts + [" "] * 12, k=rng.randrange(30))) for _ in range(rng.randrange(12))]
        ids = rebuilt.encode(texts)
        assert ids == peer.encode(texts), texts
    for text in ["", " ", "a", " a", "a ", "  a  b", "a\x00 a a\x00\x00"]:
        assert rebuilt.encode([text]) == [peer.encode(text)]
