"""Aggregations; all of them combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger.operators.sequence import page_number, run_sequence

WIDE = T.DecimalType(18, 2)


def money_sum(col: Column | str) -> Column:
    return F.coalesce(F.sum(col), F.lit(0)).cast(WIDE)


def category_balance(posted: DataFrame) -> DataFrame:
    return posted.groupBy("acct_id", "type_cd", "cat_cd").agg(money_sum("amt").alias("balance"))


def cycle_amounts(posted: DataFrame) -> DataFrame:
    """Per account: all amounts, amounts >= 0 and amounts < 0."""
    amt = F.col("amt")
    return posted.groupBy("acct_id").agg(
        money_sum("amt").alias("total_amt"),
        money_sum(F.when(amt >= 0, amt)).alias("credit_amt"),
        money_sum(F.when(amt < 0, amt)).alias("debit_amt"),
    )


def posting_counts(decisions: DataFrame) -> DataFrame:
    """Rows per reason; reason 0 is posted."""
    return decisions.groupBy("reason").agg(F.count("*").alias("rows"))


def return_code(counts: DataFrame) -> int:
    """4 when anything was rejected, else 0."""
    return 4 if counts.where(F.col("reason") != 0).limit(1).count() else 0


def interest_by_account(interest: DataFrame) -> DataFrame:
    return interest.groupBy("acct_id").agg(money_sum("interest").alias("total_interest"))


def report_rollup(tx: DataFrame) -> DataFrame:
    """Card totals and the grand total (``card_num`` NULL, ``level`` 1)."""
    return tx.rollup("card_num").agg(
        money_sum("amt").alias("total_amt"), F.count("*").alias("rows"),
        F.grouping("card_num").cast("int").alias("level"),
    )


def page_totals(tx: DataFrame, order: list[str], size: int = 20) -> DataFrame:
    """Total per page of ``size`` detail rows in report order."""
    paged = run_sequence(tx, order).withColumn("page", page_number(F.col("seq_no"), size))
    return paged.groupBy("page").agg(money_sum("amt").alias("page_total"), F.count("*").alias("rows"))


def statement_totals(xref: DataFrame, tx: DataFrame) -> DataFrame:
    """Total and row count per card, zero for cards without transactions."""
    sums = tx.groupBy("card_num").agg(F.sum("amt").alias("_sum"), F.count("*").alias("_rows"))
    return xref.join(sums, "card_num", "left").select(
        *xref.columns,
        F.coalesce("_sum", F.lit(0)).cast(WIDE).alias("total_amt"),
        F.coalesce("_rows", F.lit(0)).alias("tran_count"),
    )


def auth_summary(decided: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per account: approved and declined counts and amounts, credit balance."""
    ok = F.col("resp_code") == "00"
    return decided.groupBy(*(keys or ["acct_id"])).agg(
        F.count_if(ok).alias("approved_cnt"), F.count_if(~ok).alias("declined_cnt"),
        money_sum("approved_amt").alias("approved_amt"),
        money_sum(F.when(~ok, F.col("tran_amt"))).alias("declined_amt"),
        money_sum("approved_amt").alias("credit_balance"),
    )


def max_key(df: DataFrame, column: str = "tran_id") -> DataFrame:
    """Highest numeric key, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(F.col(column).cast("bigint")), F.lit(0)).alias("max_id"))


def type_counts(records: DataFrame, tag: str = "rec_type") -> DataFrame:
    return records.groupBy(tag).agg(F.count("*").alias("rows"))
