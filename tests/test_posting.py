"""Posting, interest, combination: hand-made edges and invariants."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cardledger.operators import aggregates as A
from cardledger.plans import combine, interest, posting
from cardledger.sources import snapshots

TS = dt.datetime(2001, 9, 1, 12, 0)
DAY = dt.date(2001, 8, 1)


def accounts(spark, rows):
    return spark.createDataFrame(
        [(a, D("0"), D(limit), exp, D("0"), D("0"), group) for a, limit, exp, group in rows],
        "acct_id bigint, curr_bal decimal(12,2), credit_limit decimal(12,2), expiry_date date, "
        "cyc_credit decimal(12,2), cyc_debit decimal(12,2), group_id string",
    )


def xref(spark, rows):
    return spark.createDataFrame(rows, "card_num string, cust_id bigint, acct_id bigint")


def daily(spark, rows):
    return spark.createDataFrame(
        [(f"{s:016d}", s, "01", 1, D(amt), card, day) for s, card, amt, day in rows],
        "tran_id string, seq bigint, type_cd string, cat_cd int, amt decimal(12,2), card_num string, orig_date date",
    )


@pytest.fixture(scope="module")
def masters(spark):
    return (
        accounts(spark, [(1, "100", dt.date(2001, 12, 31), "G"), (2, "100", DAY, "G"), (3, "100", dt.date(2001, 7, 31), "G")]),
        xref(spark, [("c1", 1, 1), ("c2", 2, 2), ("c3", 3, 3), ("c9", 9, 9)]),
    )


def reasons(spark, masters, rows, **kwargs):
    acct, cards = masters
    out = posting.decide(daily(spark, rows), cards, acct, **kwargs).collect()
    return {r.seq: r.reason for r in out}


def test_edges(spark, masters):
    rows = [
        (1, "c1", "60", DAY), (2, "c1", "50", DAY), (3, "c1", "40", DAY), (4, "c1", "0.01", DAY),
        (5, "c1", "0", DAY), (6, "c2", "1", DAY), (7, "c3", "1", DAY), (8, "c3", "999", DAY),
        (9, "c9", "1", DAY), (10, "cX", "1", DAY),
    ]
    # a smaller row fits after a refused one; limit exactly met; amount 0; expiry day itself is
    # accepted; expired beats over the limit; account missing; card unknown
    expected = {1: 0, 2: 102, 3: 0, 4: 102, 5: 0, 6: 0, 7: 103, 8: 103, 9: 101, 10: 100}
    assert reasons(spark, masters, rows) == expected
    assert reasons(spark, masters, rows, hot_rows=2, chunk_rows=2) == expected


def test_payment_uses_up_room_like_a_purchase(spark, masters):
    rows = [(1, "c1", "-80", DAY), (2, "c1", "30", DAY), (3, "c1", "-500", DAY), (4, "c1", "0", DAY)]
    assert reasons(spark, masters, rows) == {1: 0, 2: 102, 3: 0, 4: 102}


def test_job_balances(spark, masters, tmp_path):
    acct, cards = masters
    tx = daily(spark, [(i, f"c{1 + i % 4}", str(i % 7 * 3 - 4), DAY) for i in range(1, 200)])
    old = spark.createDataFrame(
        [(1, "01", 1, D("5.00")), (8, "02", 2, D("7.00"))],
        "acct_id bigint, type_cd string, cat_cd int, balance decimal(11,2)",
    )
    job = posting.post_daily(tx, cards, acct, old, TS)
    counts = dict(job.counts.collect())
    assert sum(counts.values()) == 199 and counts[0] == job.ledger.count()
    assert job.rejects.count() == 199 - counts[0]
    posted = job.ledger.agg(F.sum("amt")).first()[0]
    assert job.category_balances.agg(F.sum("balance")).first()[0] - D("12.00") == posted
    assert job.accounts.agg(F.sum("curr_bal")).first()[0] == posted
    assert A.return_code(job.counts) == 4
    assert {r.proc_ts for r in job.ledger.select("proc_ts").distinct().collect()} == {TS}
    assert set(posting.write_posting(job, str(tmp_path / "out")).values()) == {1}
    kept = snapshots.snapshot_read(spark, str(tmp_path / "out" / "ledger"))
    assert kept.count() == counts[0]


def test_interest_edges(spark):
    acct = accounts(spark, [(a, "100", DAY, "G") for a in (1, 2, 3, 5)])
    cards = xref(spark, [("c1b", 1, 1), ("c1a", 1, 1), ("c2", 2, 2), ("c3", 3, 3)])
    balances = spark.createDataFrame(
        [(1, "01", 1, D("-100.01")), (1, "02", 1, D("50.00")), (2, "01", 2, D("99.99")), (5, "01", 1, D("1.00")), (2, "09", 9, D("1.00"))],
        "acct_id bigint, type_cd string, cat_cd int, balance decimal(11,2)",
    )
    rates = spark.createDataFrame(
        [("G", "01", 1, D("15.00")), ("G", "02", 1, D("0.00")), ("DEFAULT", "01", 2, D("25.00"))],
        "group_id string, type_cd string, cat_cd int, rate decimal(6,2)",
    )
    acct = acct.withColumn("cyc_credit", F.lit(D("9.00")).cast("decimal(12,2)"))
    job = interest.interest_calc(balances, acct, cards, rates, DAY, TS)
    tx = {r.acct_id: r for r in job.transactions.collect()}
    # truncated toward zero, lowest card, default rate, no row for a zero rate
    assert tx[1].amt == D("-1.25") and tx[1].card_num == "c1a" and tx[1].tran_id == "2001-08-01000001"
    assert tx[2].amt == D("2.08") and tx[2].tran_id == "2001-08-01000002"
    assert tx[1].descr == "Int. for a/c 00000000001" and set(tx) == {1, 2}
    after = {r.acct_id: (r.curr_bal, r.cyc_credit) for r in job.accounts.collect()}
    assert after == {1: (D("-1.25"), D("0")), 2: (D("2.08"), D("0")), 3: (D("0"), D("9")), 5: (D("0"), D("9"))}
    assert {(r.acct_id, r.lookup_failed) for r in job.failed.collect()} == {(5, "card"), (2, "rate")}
    with pytest.raises(LookupError):
        interest.interest_calc(balances, acct, cards, rates, DAY, TS, strict=True)


def test_combine_refuses_repeated_ids(spark):
    ledger = spark.createDataFrame([("1", 10), ("2", 20)], "tran_id string, amt int")
    system = spark.createDataFrame([("2", 5), ("3", 30), ("3", 29)], "tran_id string, amt int")
    rows, repeated = combine.combine_transactions(ledger, system)
    assert sorted(map(tuple, rows.collect())) == [("1", 10), ("2", 20), ("3", 29)]
    assert {r.tran_id for r in repeated.collect()} == {"2", "3"}


def test_report_totals(spark):
    from cardledger.plans import reports

    tx = spark.createDataFrame(
        [(f"t{i:02d}", "01", 1, "S", D("1.50"), "c1" if i < 15 else "c2", dt.date(2001, 1, 1 + i)) for i in range(25)],
        "tran_id string, type_cd string, cat_cd int, source string, amt decimal(12,2), card_num string, proc_date date",
    )
    cards = xref(spark, [("c1", 1, 1), ("c2", 2, 2)])
    types = spark.createDataFrame([("01", "Purchase")], "type_cd string, type_desc string")
    cats = spark.createDataFrame([("01", 1, "Sale")], "type_cd string, cat_cd int, cat_desc string")
    # first and last row out of range
    rows = reports.report_rows(tx, dt.date(2001, 1, 2), dt.date(2001, 1, 24), page_size=10)
    detail = reports.report_detail(rows, cards, types, cats, strict=True)
    out = reports.transaction_report(rows, detail).collect()
    by = {k: [(r.page, r.card_num, r.amt) for r in out if r.kind == k] for k in ("page", "account", "grand")}
    assert sorted(by["page"]) == [(1, None, D("15.00")), (2, None, D("15.00")), (3, None, D("4.50"))]
    assert sorted(by["account"]) == [(None, "c1", D("21.00")), (None, "c2", D("13.50"))]
    assert by["grand"] == [(None, None, D("34.50"))] and len(out) == 23 + 3 + 2 + 1
    lines = reports.report_lines(rows, detail, dt.date(2001, 1, 2), dt.date(2001, 1, 24))
    printed = [r.line for r in lines.orderBy("sort_no", "part").collect()]
    assert {len(x) for x in printed} == {133} and printed[-1].startswith("Grand Total....")
    assert sum(x.startswith("DALYREPT") for x in printed) == 3
    none = types.where("type_cd = 'zz'")
    with pytest.raises(LookupError):
        reports.report_detail(rows, cards, none, cats, strict=True)
