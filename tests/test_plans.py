"""Shape of the physical plans: pruning, pushdown, no cross joins, no single-task steps at scale."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cardledger import fixtures
from cardledger.operators import filters, joins, sequence

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_prunes_partitions(spark, tmp_path):
    ledger = fixtures.table(spark, SF_DIR, "daily")
    path = str(tmp_path / "ledger")
    ledger.where("seq % 50 = 0").write.partitionBy("proc_date").parquet(path)
    days = (dt.date(1997, 3, 1), dt.date(1997, 3, 31))
    text = plan(filters.filter_date_range(spark.read.parquet(path), *days).select("tran_id", "amt"))
    assert "PartitionFilters: [isnotnull(proc_date" in text
    assert "ReadSchema: struct<tran_id:string,amt:decimal(12,2)>" in text


def test_timestamp_range_is_pushed_down(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    out = filters.filter_date_range(orders, dt.date(1997, 3, 1), dt.date(1997, 3, 2), "o_orderdate")
    assert "GreaterThanOrEqual(o_orderdate" in plan(out)
    days = {r[0].date() for r in out.select("o_orderdate").collect()}
    assert days <= {dt.date(1997, 3, 1), dt.date(1997, 3, 2)}


@pytest.mark.parametrize(
    "name", ["post_sequential", "auth_sequential", "interest_calc", "statements", "transaction_report",
             "apply_changes", "purge_auth", "account_view", "combine_transactions"],
)
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_transactions_are_shuffled_once_for_the_lookups(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    t = {n: fixtures.table(spark, SF_DIR, n) for n in ("daily", "xref", "account")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(joins.with_card_account(t["daily"], t["xref"], t["account"], "seq"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # masters by account, masters and transactions by card; transactions cross the network once
    assert text.count("hashpartitioning(card_num") == 2
    assert text.count("hashpartitioning(acct_id") in (2, 3)


def test_large_sequences_have_no_single_partition_over_rows(spark):
    df = fixtures.table(spark, SF_DIR, "daily").select("card_num", "tran_id")
    text = plan(sequence.run_sequence(df, ["card_num", "tran_id"], rows_per_bucket=200))
    # the only single-partition step is the running sum over one row per bucket
    assert text.count("SinglePartition") == 1


def test_default_sequences_run_in_buckets(spark):
    out = entry.queries()["latest_auth_first"](spark, SF_DIR)
    assert "__bucket" in plan(out) and "SinglePartition" not in plan(out)
    df = fixtures.table(spark, SF_DIR, "daily").select("card_num", "tran_id")
    assert plan(sequence.run_sequence(df, ["card_num", "tran_id"])).count("SinglePartition") == 1


def test_purge_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "details")
    fixtures.table(spark, SF_DIR, "auth_detail").write.parquet(path)
    details = spark.read.parquet(path)
    out = filters.filter_expired(details, dt.date(2024, 1, 20))
    assert "LessThan(auth_ts" in plan(out)
    day = F.datediff(F.lit(dt.date(2024, 1, 20)), F.to_date("auth_ts"))
    assert out.count() == details.where(day >= 5).count() > 0


def test_posting_reads_only_what_it_needs(spark):
    out = entry.queries()["post_sequential"](spark, SF_DIR)
    text = plan(out)
    assert "c_name" not in text and "c_acctbal" not in text
    assert out.agg(F.count("*")).first()[0] == 1500
