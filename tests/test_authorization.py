"""Authorization decisions, purge and the streaming jobs against the batch form."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cardledger import fixtures
from cardledger.plans import authorization as AU
from cardledger.plans import purge
from cardledger.streaming import authorization as SA
from cardledger.sources import error_log
from cardledger.streaming import expiry, run

SF_DIR = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1, 10)


def requests(spark, rows):
    return spark.createDataFrame(
        [(i, T0 + dt.timedelta(seconds=s), card, "AUTH", D(a)) for i, s, card, a in rows],
        "req_id bigint, ts timestamp, card_num string, auth_type string, amt decimal(12,2)",
    )


@pytest.fixture(scope="module")
def masters(spark):
    acct = spark.createDataFrame(
        [(1, D("100"), D("10"), D("30")), (2, D("100"), D("10"), D("0"))],
        "acct_id bigint, credit_limit decimal(12,2), cash_credit_limit decimal(12,2), curr_bal decimal(12,2)",
    )
    cards = spark.createDataFrame(
        [("c1", 1, 1), ("c2", 2, 2), ("c9", 9, 9)], "card_num string, cust_id bigint, acct_id bigint"
    )
    people = spark.createDataFrame([(1,)], "cust_id bigint")
    return cards, acct, people


ROWS = [
    (1, 0, "c1", "71"), (2, 1, "c1", "100"), (3, 2, "c1", "0.01"), (4, 3, "c1", "0"),
    (5, 5, "c2", "60"), (6, 5, "c2", "60"), (7, 6, "c2", "40"), (8, 7, "c9", "1"), (9, 8, "cX", "1"),
    (10, 4, "c2", "101"),
]
# first request is held against limit - balance; later ones against limit - approved; equal times
# go by id; a missing customer only names the decline
EXPECTED = {
    1: "4100", 2: "0000", 3: "4100", 4: "0000", 10: "3100", 5: "0000", 6: "3100", 7: "0000",
    8: "3100", 9: "3100",
}


def test_decisions(spark, masters):
    got = AU.decide(requests(spark, ROWS), *masters).collect()
    assert {r.req_id: r.resp_reason for r in got} == EXPECTED
    hot = AU.decide(requests(spark, ROWS), *masters, hot_rows=2, chunk_rows=2).collect()
    assert {r.req_id: r.resp_reason for r in hot} == EXPECTED


def test_second_run_goes_on_from_the_summaries(spark, masters):
    cards, acct, people = masters
    first = requests(spark, [r for r in ROWS if r[1] <= 4])
    later = requests(spark, [r for r in ROWS if r[1] > 4])
    stored = AU.summaries(AU.details(AU.decide(first, *masters)), acct)
    got = AU.decide(later, *masters, summaries=stored).collect()
    assert {r.req_id: r.resp_reason for r in got} == {k: v for k, v in EXPECTED.items() if 5 <= k <= 9}
    second = AU.details(AU.decide(later, *masters, summaries=stored))
    merged = AU.update_summaries(stored, second, acct)
    whole = AU.summaries(AU.details(AU.decide(requests(spark, ROWS), *masters)), acct)
    assert sorted(map(tuple, merged.select(whole.columns).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_unknown_card_stores_nothing(spark, masters):
    kept = AU.details(AU.decide(requests(spark, ROWS), *masters))
    assert {r.req_id for r in kept.collect()} == set(EXPECTED) - {9}


def test_purge_edges(spark):
    def detail(acct, day, code, amt, i):
        return (acct, dt.datetime.combine(day, dt.time(1)), i, code, D(amt), D(amt) if code == "00" else D(0))

    new_year = dt.date(2024, 1, 3)
    details = spark.createDataFrame(
        [
            detail(1, dt.date(2023, 12, 29), "00", "5", 1), detail(1, dt.date(2023, 12, 30), "05", "7", 2),
            detail(2, dt.date(2023, 12, 1), "00", "9", 3), detail(3, dt.date(2023, 12, 1), "00", "4", 4),
            detail(3, dt.date(2024, 1, 2), "05", "3", 5),
        ],
        "acct_id bigint, auth_ts timestamp, req_id bigint, resp_code string, tran_amt decimal(12,2), approved_amt decimal(12,2)",
    )
    summaries = spark.createDataFrame(
        [(1, D("5"), 1, 1, D("5"), D("7")), (2, D("9"), 1, 0, D("9"), D("0")), (3, D("4"), 1, 1, D("4"), D("3"))],
        "acct_id bigint, credit_balance decimal(12,2), approved_cnt bigint, declined_cnt bigint, "
        "approved_amt decimal(12,2), declined_amt decimal(12,2)",
    )
    job = purge.purge_auth(summaries, details, new_year, days=5)
    # exactly five days old across the year end expires; only declined left keeps the summary
    left = {r.acct_id: (r.approved_cnt, r.declined_cnt, r.credit_balance) for r in job.summaries.collect()}
    assert left == {1: (0, 1, D("5")), 3: (0, 1, D("4"))}
    assert {r.req_id for r in job.details.collect()} == {2, 5}
    assert tuple(job.counts.first()) == (3, 1, 5, 3)
    freed = purge.purge_auth(summaries, details, new_year, days=5, release_credit=True)
    assert {r.acct_id: r.credit_balance for r in freed.summaries.collect()} == {1: D("0"), 3: D("0")}


def write_in_order(df, path, key, parts):
    """Files whose names and times follow the key, so that the stream reads them in order."""
    bounds = [r[0] for r in df.select(key).orderBy(key).collect()]
    step = -(-len(bounds) // parts)
    for n in range(parts):
        lo, hi = bounds[n * step], bounds[min((n + 1) * step, len(bounds)) - 1]
        df.where(F.col(key).between(lo, hi)).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("files", [1, 2])
def test_stream_equals_batch(spark, tmp_path, files):
    t = {n: fixtures.table(spark, SF_DIR, n) for n in ("events", "xref", "auth_account", "customer_master", "auth_request")}
    batch = AU.decide(t["auth_request"], t["xref"], t["auth_account"], t["customer_master"])
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))

    def go():
        stream = run.read_files(spark, src, t["events"].schema, files)
        asked = spark.sql(fixtures.VIEWS["auth_request"], events=stream)
        decided = SA.auth_decide_stream(asked, t["xref"], t["auth_account"], t["customer_master"])
        run.run_batches(
            decided, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), ckpt, "update"
        )

    events = t["events"]
    cut = 600
    write_in_order(events.where(F.col("event_id") < cut), src, "event_id", 2)
    go()
    # more arrives, the job is started again from its checkpoint
    write_in_order(events.where(F.col("event_id") >= cut), src, "event_id", 2)
    go()
    cols = ["req_id", "resp_code", "resp_reason", "approved_amt"]
    got = spark.read.parquet(out).select(cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_expiry_stream_reports_late_rows(spark, tmp_path):
    def detail(i, day):
        return (1, dt.datetime(2024, 1, day, 3), i, "00", D("1.00"), D("1.00"))

    schema = "acct_id bigint, auth_ts timestamp, req_id bigint, resp_code string, tran_amt decimal(12,2), approved_amt decimal(12,2)"
    src, store, ckpt = (str(tmp_path / n) for n in ("src", "store", "ckpt"))
    runs = [[(1, 1), (2, 4)], [(3, 6), (4, 7)], [(5, 2), (6, 12)], [(7, 12)]]
    # what a run expires: the 1st when the 6th is seen, all up to the 7th with the 12th, the late 2nd at once
    expected = [set(), {1}, {1, 2, 4, 6, 7}, {1, 2, 4, 6, 7}]
    for rows, days in zip(runs, expected):
        df = spark.createDataFrame([detail(*r) for r in rows], schema)
        df.coalesce(1).write.mode("append").parquet(src)
        stream = run.read_files(spark, src, df.schema, 1)
        expiry.auth_expiry_stream(stream, store, ckpt, days=5)
        gone = spark.read.schema("acct_id bigint, auth_date date, approved_cnt bigint, approved_amt decimal(18,2)").parquet(f"{store}/expired")
        got = [(r.auth_date.day, r.approved_cnt, r.approved_amt) for r in gone.collect()]
        assert sorted(got) == sorted((d, 1, D("1.00")) for d in days)
    late = error_log.read_errors(spark, f"{store}/late").collect()
    assert [(r.event_key, r.level, r.err_date) for r in late] == [("5", "W", "240102")]


def test_expiry_sums_a_day_over_batches(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1, i), i, "00" if i % 2 else "05", D("2.00"), D("2.00") if i % 2 else D("0")) for i in range(4)]
    rows += [(2, dt.datetime(2024, 1, 1, 5), 10, "00", D("7.00"), D("7.00")), (1, dt.datetime(2024, 2, 1), 11, "00", D("1"), D("1"))]
    schema = "acct_id bigint, auth_ts timestamp, req_id bigint, resp_code string, tran_amt decimal(12,2), approved_amt decimal(12,2)"
    src, store, ckpt = (str(tmp_path / n) for n in ("src", "store", "ckpt"))
    for row in rows:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(src)
    expiry.auth_expiry_stream(run.read_files(spark, src, spark.createDataFrame([], schema).schema, 1), store, ckpt, days=5)
    gone = spark.read.parquet(f"{store}/expired").collect()
    assert sorted((r.acct_id, r.approved_cnt, r.declined_cnt, r.approved_amt, r.declined_amt) for r in gone) == [
        (1, 2, 2, D("4.00"), D("4.00")), (2, 1, 0, D("7.00"), D("0.00"))
    ]
