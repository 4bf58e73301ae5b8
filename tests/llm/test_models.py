import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from cardledger.llm import language, pieces, quality
from cardledger.llm.common import table
from cardledger.llm.sample import sample_by
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_languages_held_out(spark):
    docs = table(spark, SF, "documents")
    found = language.identify(docs)
    both = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    assert len(both) > 30
    assert np.mean([r["lang"] == r["lang_pred"] for r in both]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in both)


def test_languages_of_odd_texts(spark):
    learn = table(spark, SF, "documents")
    got = brute.by_id(language.identify(brute.frame(spark, repeat=True), learn, sample=20))
    for i, text, _ in brute.DOCS:
        r = got[i]
        assert r["held_out"] == brute.held_out(i)
        if text and any(map(str.isalpha, text)):
            assert r["lang_pred"] in {"en", "de", "fr", "es"} and r["score"] > 0
        else:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    nothing = brute.frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(nothing).collect()} == {"und"}
    assert language.identify(brute.frame(spark, []), learn, sample=5).collect() == []


def test_predictions_do_not_read_lang_or_source(spark):
    docs = table(spark, SF, "documents")
    blank = docs.where("doc_id < 40").select("doc_id", "text")
    got = brute.by_id(language.identify(blank, docs, sample=20))
    want = brute.by_id(language.identify(docs, sample=20).where("doc_id < 40"))
    assert got == want


def _enumerate(scores, transitions, start):
    """Probabilities of labels by summing over all label sequences of one line."""
    n, k = scores.shape
    total, post, pairs = 0.0, np.zeros((n, k)), np.zeros((k, k))
    for path in np.ndindex(*[k] * n):
        w = np.exp(start[path[0]] + sum(scores[t, y] for t, y in enumerate(path)))
        w *= np.exp(sum(transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += w
        for t, y in enumerate(path):
            post[t, y] += w
        for a, b in zip(path, path[1:], strict=False):
            pairs[a, b] += w
    return post / total, pairs / total


def test_forward_backward_against_all_label_sequences():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 1, 5, 2, 5])
    scores, transitions, start = rng.normal(size=(16, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    layout = language.Lines.of(lengths)
    laid, pairs = language.forward_backward(scores[layout.order], layout.active, transitions, start, pairs=True)
    post = np.empty_like(laid)
    post[layout.order] = laid
    want = [_enumerate(scores[e - n : e], transitions, start) for n, e in zip(lengths, lengths.cumsum(), strict=True)]
    assert np.allclose(post, np.concatenate([w for w, _ in want]))
    assert np.allclose(pairs, sum(p for _, p in want))


def test_words_of_mixed_lines_get_their_own_language():
    rows = [("en", "the house and the garden\nthe tree and a bird")] * 30 + [("de", "das haus und der garten\nder baum und ein vogel")] * 30
    field = language.fit(rows, epochs=8)
    words = "the house and the tree das haus und der baum".split()
    layout = language.Lines.of(np.array([len(words)]))
    post, _ = language.forward_backward(field.emissions(words), layout.active, field.transitions, field.start)
    assert [field.languages[k] for k in post.argmax(axis=1)] == ["en"] * 5 + ["de"] * 5


def test_feature_ids_stay_inside_words():
    owner, feature = language.feature_ids(["ab", "c", "ab"])
    own = [sorted(feature[owner == k].tolist()) for k in range(3)]
    assert own[0] == own[2] and len(own[0]) == 3 + 2 + 1 and len(own[1]) == 2 + 1


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    both = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = [r["predicted"] == r["quality"] for r in both]
    assert len(both) > 60 and np.mean(right) > 0.9
    good, bad = ([r["score"] for r in both if r["quality"] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.9


def test_quality_of_odd_texts(spark):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(
        brute.frame(spark, [(i and i + 10**6, t, x) for i, t, x in brute.DOCS]).select("doc_id", "text")
    )
    out = quality.quality(docs, labels.withColumn("text", F.lit("clash"))).collect()
    assert len(out) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    one = labels.where("quality = 1").unionByName(labels.withColumn("quality", F.lit(None).cast("int")))
    assert {r["score"] for r in quality.quality(docs, one).collect()} == {1.0}
    assert {r["score"] for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(docs.limit(0), labels).collect() == []


def test_sample_is_bounded_and_drawn_by_id(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 10 = 0, 'a', 'b') AS label", "'t' AS text")
    drawn, counts = sample_by(rows, "label", 100, 10)
    assert counts == {"a": 2000, "b": 18000}
    assert all(50 < sum(x == k for x, _ in drawn) < 160 for k in "ab")
    assert drawn == sample_by(rows.repartition(7), "label", 100, 10)[0]


def test_pieces(spark):
    out = brute.by_id(pieces.piece_tokens(brute.frame(spark, repeat=True)))
    peer = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for i, text, _ in brute.DOCS:
        r = out[i]
        assert r["token_ids"] == peer.encode(text or "") and r["round_trip"] and r["parity"], i
        assert r["n_tokens"] == len(r["token_ids"])
        assert r["n_byte_tokens"] == sum(peer.is_byte(x) for x in r["token_ids"])
    assert pieces.piece_tokens(brute.frame(spark, [])).collect() == []


@pytest.mark.parametrize("chunk", [7, 40, 1 << 20])
def test_long_texts_are_cut_where_no_piece_reaches(chunk, monkeypatch):
    monkeypatch.setattr(pieces, "_CHUNK", chunk)
    with open(pieces.MODEL, "rb") as file:
        rebuilt = pieces.PieceTokenizer(file.read())
    peer = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = ["", " ", "  a   b ", brute.PROSE * 3, "x" * 100, "▁ ▁▁ a", "line\n\n  two\t", "𝔘 日本 <s> <0x41>", "   " * 30 + "end"]
    ids = rebuilt.encode(texts)
    assert ids == peer.encode(texts)
    assert rebuilt.decode(ids)[:5] == texts[:5]


def _message(*fields):
    """A protobuf message of (number, int | bytes | float) fields."""
    import struct

    def varint(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])

    out = b""
    for number, value in fields:
        if isinstance(value, bytes):
            out += varint(number << 3 | 2) + varint(len(value)) + value
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            out += varint(number << 3) + varint(value)
    return out


def test_unigram_model_with_byte_fallback():
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    listed += [("▁", -3.0, 1), ("▁ab", -4.0, 1), ("a", -5.0, 1), ("b", -5.5, 1), ("abc", -9.0, 1), ("c", -6.0, 1), ("▁a", -4.5, 1)]
    data = b"".join(_message((1, _message((1, p.encode()), (2, s), (3, k)))) for p, s, k in listed)
    data += _message((2, _message((3, 1), (35, 1), (40, 0))), (3, _message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    model = pieces.PieceModel.parse(data)
    assert (model.kind, model.byte_fallback, model.unk_id, model.trim_spaces) == (1, True, 0, False)
    rebuilt = pieces.PieceTokenizer(data)
    peer = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["abc ab cab", "a é b", "bb  aab", "", "日a"]
    ids = rebuilt.encode(texts)
    assert ids == peer.encode(texts)
    assert rebuilt.decode(ids) == texts
