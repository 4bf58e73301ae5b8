from collections import Counter

import numpy as np
import sentencepiece

import corpus_pipeline as P
from cardledger.llm import pieces
from cardledger.llm.common import table
from cardledger.llm.language import identify
from tests.llm import brute

SF = "/root/testdata/sf0.001"
STAGES = dict(P.STAGES)


def bench(spark, path):
    spark.createDataFrame([(1, brute.LEAK), (2, "Only THREE words"), (None, None)], "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    return str(path)


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda x: (x is None, x or 0))


def order(found):
    return sorted(found, key=lambda x: (x is None, x or 0))


def test_each_stage_on_odd_documents(spark, tmp_path):
    sf = bench(spark, tmp_path)
    docs = brute.frame(spark)
    texts = {i: t for i, t, _ in brute.DOCS}
    assert ids(STAGES["exact_dedup"](spark, docs, sf)) == order(
        i for i, (keep, *_) in brute.exact(brute.DOCS).items() if i == keep
    )
    near = brute.near({i: brute.simhash(t) for i, t in texts.items()})
    assert ids(STAGES["simhash_near_dedup"](spark, docs, sf)) == order(i for i, root in near.items() if i == root)
    hits = brute.leaks(brute.DOCS, [(1, brute.LEAK), (2, "Only THREE words")])
    kept = STAGES["benchmark_decontamination"](spark, docs, sf)
    assert ids(kept) == order(i for i, (_, n, _) in hits.items() if not n)
    assert kept.columns == docs.columns
    letters = order(i for i, t in texts.items() if t and any(map(str.isalpha, t)))
    assert set(ids(STAGES["language_id"](spark, docs, sf))) <= set(letters)
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs.limit(0), sf)
        assert out.columns == docs.columns and out.collect() == []


def test_clean_documents_pass_the_language_stage(spark):
    docs = table(spark, SF, "documents")
    kept = ids(STAGES["language_id"](spark, docs, SF))
    letters = [r["doc_id"] for r in docs.collect() if any(map(str.isalpha, r["text"] or ""))]
    assert len(kept) >= 0.99 * len(letters)


#: A text in none of the learned languages, and one without sense.
FOREIGN = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, heille on annettu järki"
NONSENSE = "xqzj vkwq zzxv jqkx wvzq qxjz kvwx zjqv xwkz vqzx jkwv qzvx"


def test_a_document_in_no_learned_language_goes(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, FOREIGN, None), (-2, NONSENSE, None), (-3, FOREIGN, None)], docs.schema)
    kept = set(ids(STAGES["language_id"](spark, docs.unionByName(odd), SF)))
    assert not kept & {-1, -2, -3}
    assert kept == set(ids(STAGES["language_id"](spark, docs, SF)))


def test_a_language_left_out_of_learning_goes(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = identify(docs, docs.where("lang <> 'fr'")).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out AND lang_pred <> 'und'").collect()
    assert np.mean([r["known"] < P.MIN_KNOWN for r in rows if r["lang"] == "fr"]) > 0.9
    assert all(r["known"] >= P.MIN_KNOWN for r in rows if r["lang"] != "fr")


def test_stages_on_repeated_rows(spark, tmp_path):
    """Rows that share an id stay or go together."""
    sf = bench(spark, tmp_path)
    docs = brute.frame(spark, repeat=True)
    times = Counter(r["doc_id"] for r in docs.collect())
    assert max(times.values()) == 2
    for _, stage in P.STAGES[:-1]:
        kept = Counter(ids(stage(spark, docs, sf)))
        assert kept and all(n == times[i] for i, n in kept.items())
    assert Counter(ids(STAGES["sentencepiece"](spark, docs, sf))) == times


def test_run_against_plain_stages(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in STAGES["language_id"](spark, docs, SF).collect()]
    for decide in (
        lambda rs: {i for i, (keep, *_) in brute.exact(rs).items() if i == keep},
        lambda rs: {i for i, root in brute.near({i: brute.simhash(t) for i, t, _ in rs}).items() if i == root},
        lambda rs: {i for i, (_, n, _) in brute.leaks(rs, items).items() if not n},
    ):
        items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
        kept = decide(rows)
        rows = [r for r in rows if r[0] in kept]
    peer = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = {r["doc_id"]: r["token_ids"] for r in P.run(spark, SF).collect()}
    assert got == {i: peer.encode(t or "") for i, t, _ in rows}
    assert 0 < len(got) < docs.count()
