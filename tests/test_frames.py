"""Rows of a key in order by way of state, with a bounded number of them in memory."""

import datetime as dt
import random
from decimal import Decimal as D

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardledger.plans import authorization as AU
from cardledger.streaming import authorization as SA
from cardledger.streaming import frames, run


class Held:
    """Map state in a dict."""

    def __init__(self):
        self.of, self.most = {}, 0

    def updateValue(self, key, value):
        self.of[key] = value
        self.most = max(self.most, len(self.of))

    def getValue(self, key):
        return self.of[key]

    def removeKey(self, key):
        del self.of[key]


@pytest.mark.parametrize("n, size", [(0, 5), (1, 5), (5, 5), (6, 5), (500, 7), (3000, 10)])
def test_sorted(n, size, monkeypatch):
    rng = random.Random(n)
    t0 = pd.Timestamp("2024-01-01")
    rows = pd.DataFrame(
        {"ts": [t0 + pd.Timedelta(seconds=rng.randrange(40)) for _ in range(n)], "req_id": [rng.randrange(n // 2 + 1) for _ in range(n)],
         "amt": range(n), "note": [None if i % 3 else "x" for i in range(n)]}
    )
    loaded = []
    load = frames.SortedFrames._load

    def counting(self, run, place):
        piece = load(self, run, place)
        loaded.append(len(piece))
        return piece

    monkeypatch.setattr(frames.SortedFrames, "_load", counting)
    held = Held()
    given = (rows.iloc[i : i + size] for i in range(0, n, size))
    got = list(frames.SortedFrames(held, ["ts", "req_id"], rows=3, fan=4).take(given))
    assert not held.of
    assert all(len(f) <= max(4 * 3, size) for f in got) and all(k <= 3 for k in loaded)
    if n:
        whole = pd.concat(got, ignore_index=True)
        keys = list(zip(whole["ts"], whole["req_id"]))
        assert keys == sorted(zip(rows["ts"], rows["req_id"]))
        assert sorted(whole["amt"]) == list(range(n))
        assert (whole["ts"] == rows["ts"].iloc[whole["amt"]].to_numpy()).all()


def test_a_key_with_many_frames(spark, tmp_path):
    """One account with most rows, in small Arrow batches and no order, against the batch form."""
    n = 6000
    rng = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    order = list(range(n))
    rng.shuffle(order)
    rows = [
        (i, t0 + dt.timedelta(seconds=i // 3), "c1" if i % 10 else "c2", "AUTH", D(rng.randrange(-300, 500)) / 100)
        for i in order
    ]
    asked = spark.createDataFrame(rows, "req_id bigint, ts timestamp, card_num string, auth_type string, amt decimal(12,2)")
    accounts = spark.createDataFrame(
        [(1, D("900"), D("10"), D("30")), (2, D("100"), D("10"), D("0"))],
        "acct_id bigint, credit_limit decimal(12,2), cash_credit_limit decimal(12,2), curr_bal decimal(12,2)",
    )
    cards = spark.createDataFrame([("c1", 1, 1), ("c2", 2, 2)], "card_num string, cust_id bigint, acct_id bigint")
    people = spark.createDataFrame([(1,), (2,)], "cust_id bigint")
    src, store, ckpt = (str(tmp_path / x) for x in ("src", "store", "ckpt"))
    asked.where(F.col("req_id") < 4000).coalesce(1).write.mode("append").parquet(src)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "150")
    try:
        for later in (False, True):
            if later:
                asked.where(F.col("req_id") >= 4000).coalesce(1).write.mode("append").parquet(src)
            stream = run.read_files(spark, src, asked.schema, 1)
            SA.auth_store_stream(SA.auth_decide_stream(stream, cards, accounts, people), store, ckpt, buckets=4)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    batch = AU.decide(asked, cards, accounts, people)
    cols = ["req_id", "resp_code", "resp_reason", "approved_amt"]
    assert sorted(map(tuple, spark.read.parquet(f"{store}/decisions").select(cols).collect())) == sorted(
        map(tuple, batch.select(cols).collect())
    )
    whole = AU.summaries(AU.details(batch), accounts).drop("cash_balance")
    got = SA.stored_summaries(spark, store, buckets=4).select(whole.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
