"""Monthly interest on category balances."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions.money import trunc_cents
from cardledger.functions.text import pad_key
from cardledger.operators.aggregates import money_sum
from cardledger.operators.changes import apply_interest
from cardledger.operators.joins import first_card, join_rate_with_default, require_lookups
from cardledger.operators.sequence import run_sequence
from cardledger.session import materialize


@dataclass
class Interest:
    transactions: DataFrame
    totals: DataFrame
    accounts: DataFrame
    failed: DataFrame


def balances_with_lookups(
    balances: DataFrame, accounts: DataFrame, xref: DataFrame, rates: DataFrame
) -> DataFrame:
    """Category balances with group, card and rate; ``lookup_failed`` names what is missing."""
    groups = accounts.select("acct_id", "group_id", F.lit(True).alias("_acct"))
    out = balances.join(groups, "acct_id", "left").join(first_card(xref), "acct_id", "left")
    out = join_rate_with_default(out, rates)
    failed = (
        F.when(F.col("_acct").isNull(), "account")
        .when(F.col("card_num").isNull(), "card")
        .when(F.col("rate").isNull(), "rate")
    )
    return out.withColumn("lookup_failed", failed).drop("_acct")


def monthly_interest(looked_up: DataFrame) -> DataFrame:
    """Interest per category balance; a zero rate gives no row."""
    good = looked_up.where(F.col("lookup_failed").isNull() & (F.col("rate") != 0))
    return good.withColumn("interest", trunc_cents(F.col("balance"), F.col("rate")))


#: Characters of a running number above its digits, in ASCII order.
_PLACES = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def running_number(number: Column) -> Column:
    """A number from 0 as six characters that sort like the numbers.

    Up to 999,999 these are digits.  Above, the first character is a letter and the other five count on
    in digits, capitals and small letters, which is enough for 47 billion; more is an error.
    """
    base = len(_PLACES)
    beyond = number - 1_000_000

    def place(power: int) -> Column:
        digit = F.call_function("div", beyond, F.lit(base**power)) % base
        return F.substring(F.lit(_PLACES), (digit + 1).cast("int"), F.lit(1))

    first = F.call_function("div", beyond, F.lit(base**5)) + 11
    letters = F.concat(F.substring(F.lit(_PLACES), first.cast("int"), F.lit(1)), *[place(k) for k in range(4, -1, -1)])
    most = 1_000_000 + (base - 10) * base**5
    return (
        F.when(number < 1_000_000, F.lpad(number.cast("string"), 6, "0"))
        .when(number < most, letters)
        .otherwise(F.raise_error(F.concat(F.lit("no running number of six characters for "), number)).cast("string"))
    )


def interest_calc(
    balances: DataFrame,
    accounts: DataFrame,
    xref: DataFrame,
    rates: DataFrame,
    run_date: dt.date,
    run_ts: dt.datetime,
    strict: bool = False,
) -> Interest:
    """One interest transaction per category balance and the accounts after it.

    A transaction id is the run date and a running number over (account, type, category), six characters
    wide at any count (``running_number``).  Every account that has a category balance starts a new cycle.
    Balances whose account, card or rate is missing are set aside in ``failed``, or raise when
    ``strict``.
    """
    # Written once: numbering, totals and the failed rows all start from it.
    looked_up = materialize(balances_with_lookups(balances, accounts, xref, rates), "interest")
    if strict:
        require_lookups(looked_up)
    interest = monthly_interest(looked_up)
    numbered = run_sequence(interest, ["acct_id", "type_cd", "cat_cd"], "_n")
    stamp = F.lit(run_ts).cast("timestamp")
    # Type, category, source and text of an interest transaction.
    transactions = numbered.select(
        F.concat(F.lit(run_date.isoformat()), running_number(F.col("_n"))).alias("tran_id"),
        F.lit("01").alias("type_cd"), F.lit(5).alias("cat_cd"), F.lit("System").alias("source"),
        F.concat(F.lit("Int. for a/c "), pad_key(F.col("acct_id"), 11)).alias("descr"),
        F.col("interest").alias("amt"), F.lit(0).cast("bigint").alias("merchant_id"),
        "card_num", "acct_id", stamp.alias("orig_ts"), stamp.alias("proc_ts"),
    )
    totals = interest_totals(looked_up)
    return Interest(
        transactions=transactions,
        totals=totals,
        accounts=apply_interest(accounts, totals),
        failed=looked_up.where(F.col("lookup_failed").isNotNull()),
    )


def interest_totals(looked_up: DataFrame) -> DataFrame:
    """Total per account; an account whose balances all have a zero rate gets a zero total."""
    amount = F.when(F.col("rate") != 0, trunc_cents(F.col("balance"), F.col("rate")))
    good = looked_up.where(F.col("lookup_failed").isNull())
    return good.groupBy("acct_id").agg(money_sum(amount).alias("total_interest"))
