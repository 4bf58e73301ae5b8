"""The pipeline's stages hand few texts over at a time, whatever the session had before."""

import pyarrow as pa
import pytest

import corpus_pipeline
from cardledger.llm import common

SF = "/root/testdata/sf0.001"
#: Rows of texts that Spark's own limit of 10,000 rows puts into one batch of 12 MB, and a text's characters.
ROWS, CHARS = 3000, 4000


def _sizes(batches):
    for batch in batches:
        sizes = pa.array([batch.num_rows]), pa.array([batch.nbytes])
        yield pa.RecordBatch.from_arrays(list(sizes), ["n", "bytes"])


@pytest.fixture
def session(spark):
    """A session with Spark's own limits."""
    keys = list(common.SMALL_BATCHES)
    before = [spark.conf.get(k, None) for k in keys]
    for key in keys:
        spark.conf.unset(key)
    yield spark
    for key, value in zip(keys, before, strict=True):
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_hands_small_batches_to_python(session, monkeypatch, name, stage):
    seen = []

    def operator(docs, *_):
        big = docs.limit(0).select("doc_id", "text").unionByName(
            session.range(0, ROWS, 1, 1).selectExpr("id AS doc_id", f"repeat('x', {CHARS}) AS text")
        )
        seen.extend(big.mapInArrow(_sizes, "n long, bytes long").collect())
        return docs.selectExpr(
            "doc_id", "'en' AS lang_pred", "1.0 AS known", "true AS kept", "doc_id AS component_id", "false AS contaminated"
        )

    for own in ("identify", "exact_dedup", "simhash_components", "decontaminate", "piece_tokens"):
        monkeypatch.setattr(corpus_pipeline, own, operator)
    docs = session.createDataFrame([(1, "one"), (2, None)], "doc_id bigint, text string")
    assert stage(session, docs, SF).count() == 2
    assert sum(r["n"] for r in seen) == ROWS
    assert max(r["bytes"] for r in seen) < 6 << 20


def test_a_scan_decodes_few_rows_at_a_time(session, tmp_path):
    session.range(0, ROWS, 1, 1).selectExpr("id AS doc_id", "'x' AS text").write.parquet(f"{tmp_path}/docs")
    common.small_batches(session)
    plan = session.read.parquet(f"{tmp_path}/docs")._jdf.queryExecution().executedPlan()
    assert plan.executeCollectPublic() is not None
    metrics = _metric(plan, "numInputBatches")
    assert metrics >= ROWS / 512


def _metric(plan, name):
    """Greatest value of a metric among the operators of a plan."""
    found = plan.metrics().get(name)
    own = found.get().value() if found.isDefined() else 0
    children = plan.children()
    return max([own, *(_metric(children.apply(i), name) for i in range(children.size()))])
