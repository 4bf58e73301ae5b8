"""Streams over many accounts: state by groups of accounts, few large micro-batches, masters merged."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cardledger.catalog import streams
from cardledger.catalog.registry import Tables
from cardledger.plans import authorization as AU
from cardledger.streaming import authorization as SA
from cardledger.streaming import expiry, inquiry, run

ACCOUNTS = 700


@pytest.fixture(scope="module")
def masters(spark):
    ids = spark.range(ACCOUNTS)
    accounts = ids.selectExpr(
        "id AS acct_id", "CAST(900 AS DECIMAL(12,2)) AS credit_limit", "CAST(10 AS DECIMAL(12,2)) AS cash_credit_limit",
        "CAST(id % 900 AS DECIMAL(12,2)) AS curr_bal",
    ).where("acct_id % 50 <> 7")
    cards = ids.selectExpr("concat('c', id) AS card_num", "id AS cust_id", "id AS acct_id")
    return cards, accounts, ids.selectExpr("id AS cust_id")


def requests(spark, begin, end):
    return spark.range(begin, end).selectExpr(
        "id AS req_id", "TIMESTAMP '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id DIV 3) AS ts",
        f"concat('c', id * 7919 % {ACCOUNTS + 20}) AS card_num", "'AUTH' AS auth_type",
        "CAST(id * 31 % 700 - 50 AS DECIMAL(12,2)) AS amt",
    )


def two_files(df, later, src):
    for own in (df, later):
        own.coalesce(1).write.mode("append").parquet(src)


def plan(query) -> str:
    return query._jsq.explainInternal(False)


def test_decisions_keep_state_by_groups(spark, masters, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    asked = requests(spark, 0, 6000)
    two_files(requests(spark, 0, 3500), requests(spark, 3500, 6000), src)
    decided = SA.auth_decide_stream(run.read_files(spark, src, asked.schema, 1), *masters)
    query = run.run_batches(decided, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), ckpt, "update")
    # a key for every account, and one for every request with an unknown card, before
    assert all(p.stateOperators[0].numRowsTotal <= SA.STATE_GROUPS < ACCOUNTS for p in query.recentProgress)
    cols = ["req_id", "acct_id", "resp_code", "resp_reason", "approved_amt"]
    got = spark.read.parquet(out)
    want = AU.decide(asked, *masters)
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)
    whole = AU.summaries(AU.details(want), masters[1]).drop("cash_balance")
    last = SA.latest_summaries(got).select(whole.columns)
    assert sorted(map(tuple, last.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    # an unknown card has no sums of earlier requests
    unknown = got.where("acct_id IS NULL")
    assert unknown.count() > 100 and unknown.agg(F.max("s_declined_cnt")).first()[0] == 1


def test_expiry_keeps_state_by_groups(spark, tmp_path):
    src, store, ckpt = (str(tmp_path / n) for n in ("src", "store", "ckpt"))
    rows = [
        (None if a == 0 else a, dt.datetime(2024, 1, day, 1), a, "05" if a % 5 == 0 else "00", D("2.00"), D("0") if a % 5 == 0 else D("2.00"))
        for day in (1, 2) for a in range(ACCOUNTS)
    ]
    end = [(1, dt.datetime(2024, 1, 6), 1, "00", D("1"), D("1"))]
    schema = "acct_id bigint, auth_ts timestamp, req_id bigint, resp_code string, tran_amt decimal(12,2), approved_amt decimal(12,2)"
    df = spark.createDataFrame(rows, schema)
    two_files(df, spark.createDataFrame(end, schema), src)
    query = expiry.auth_expiry_stream(run.read_files(spark, src, df.schema, 1), store, ckpt, days=5)
    most = max(p.stateOperators[0].numRowsTotal for p in query.recentProgress)
    assert most <= 4 * 3 * expiry.STATE_GROUPS < 4 * ACCOUNTS  # a day's sums, its timer and their indexes
    got = {r.acct_id: tuple(r) for r in spark.read.parquet(f"{store}/expired").drop("batch").collect()}
    first = dt.date(2024, 1, 1)
    assert got == {
        a: (a, first, 0, 1, D("0.00"), D("2.00")) if i % 5 == 0 else (a, first, 1, 0, D("2.00"), D("0.00"))
        for i, a in enumerate([None, *range(1, ACCOUNTS)])
    }


def test_streams_do_not_broadcast_masters(spark, masters, tmp_path):
    src = str(tmp_path / "src")
    two_files(requests(spark, 0, 50), requests(spark, 50, 90), src)
    stream = run.read_files(spark, src, requests(spark, 0, 1).schema, 1)
    enriched = SA.auth_enrich_stream(stream, *masters)
    asked = stream.selectExpr("req_id", "'INQA' AS func", "req_id AS acct_key")
    replies = inquiry.account_inquiry_stream(asked, masters[1].select("acct_id", "curr_bal"))
    for name, df in (("enriched", enriched), ("replies", replies)):
        out = str(tmp_path / name)
        made = plan(run.run_to_files(df, out, f"{out}-checkpoint"))
        assert "SortMergeJoin" in made and "Broadcast" not in made
        assert spark.read.parquet(out).count() == 90


def test_event_files_follow_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "EVENTS_PER_BATCH", 300)
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 2)
    t = Tables(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "out")
    run.run_batches(
        streams.event_stream(t), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), str(tmp_path / "ckpt")
    )
    n = t.events.count()
    spans = spark.read.parquet(out).groupBy("batch").agg(F.count("*"), F.min("ts"), F.max("ts")).orderBy("batch").collect()
    assert [r[1] for r in spans] == [300] * (n // 300) + [n % 300] * (n % 300 > 0)
    assert all(a[3] <= b[2] for a, b in zip(spans, spans[1:]))


def test_a_micro_batch_holds_many_events():
    assert streams.EVENTS_PER_BATCH >= 500_000  # each costs seconds whatever it holds
