"""Authorization decisions in arrival order, their summaries and details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions.money import cents
from cardledger.operators import aggregates as A
from cardledger.operators.headroom import fold_in_order
from cardledger.operators.joins import account_view, card_facts
from cardledger.session import materialize

MONEY = "decimal(12,2)"


def enrich(requests: DataFrame, xref: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Left-join card, account and customer; batch or stream on the left.

    ``fold_key`` is the account or, for an unknown card, a negative number of the request's own.  For a
    stream the masters are joined with each other once, not again for every micro-batch, and
    are merged: a broadcast would pass the driver with each of them.
    """
    people = customers.select("cust_id", F.lit(True).alias("customer_found"))
    cards = xref.select("card_num", "acct_id", "cust_id").join(people, "cust_id", "left")
    limits = accounts.select("acct_id", "credit_limit", "cash_credit_limit", "curr_bal")
    facts = card_facts(cards, limits)
    if requests.isStreaming:
        facts = materialize(facts, "card-facts").hint("merge")
    out = requests.join(facts, "card_num", "left")
    return out.withColumns(
        {
            "fold_key": F.coalesce("acct_id", -1 - F.col("req_id")),
            "account_found": F.coalesce("account_found", F.lit(False)),
            "customer_found": F.coalesce("customer_found", F.lit(False)),
        }
    )


def auth_reason(
    approved: Column, card_found: Column, account_found: Column, customer_found: Column, funds: Column
) -> Column:
    """Reason of a decision; a missing customer does not decline but names the decline.

    ``funds`` is true when the decline is for lack of funds.
    """
    # Reason codes.
    return (
        F.when(approved, "0000")
        .when(~card_found | ~account_found | ~customer_found, "3100")
        .when(funds, "4100")
        .otherwise("9000")
    )


def decide(
    requests: DataFrame,
    xref: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    summaries: DataFrame | None = None,
    **fold: int,
) -> DataFrame:
    """Decide all requests, per account in (ts, req_id) order.

    The first request of an account without a summary is held against limit - current balance,
    every later one against limit - sum of approved amounts.  In headroom terms: start = limit -
    credit balance, gate = weight = amount, and the first gate is raised by what the first test
    takes off in addition.
    """
    rows = enrich(requests, xref, accounts, customers)
    per_card = requests.groupBy("card_num").agg(
        F.count("*").alias("_n"), F.min(F.struct("ts", "req_id")).alias("_first")
    )
    per_key = (
        per_card.join(xref.select("card_num", "acct_id"), "card_num")
        .groupBy(F.col("acct_id").alias("fold_key"))
        .agg(F.sum("_n").alias("n"), F.min("_first").alias("_first"))
    )
    known = per_key.select("fold_key", F.col("_first.req_id").alias("_first_req"))
    if summaries is not None:
        known = known.join(
            summaries.select(
                F.col("acct_id").alias("fold_key"), F.col("credit_limit").alias("_old_limit"),
                F.col("credit_balance").alias("_old_balance"),
            ),
            "fold_key", "left",
        )
    else:
        known = known.withColumn("_old_limit", F.lit(None).cast(MONEY)).withColumn(
            "_old_balance", F.lit(None).cast(MONEY)
        )
    rows = rows.join(known, "fold_key", "left")
    zero = F.lit(0).cast("bigint")
    amount = F.coalesce(cents(F.col("amt")), zero)
    extra = F.when(F.col("_old_limit").isNull(), F.col("curr_bal")).otherwise(
        F.col("credit_limit") - F.col("_old_limit")
    )
    is_first = F.coalesce(F.col("req_id") == F.col("_first_req"), F.lit(False))
    folded = fold_in_order(
        rows.select(
            *requests.columns, "acct_id", "cust_id", "fold_key", "account_found", "customer_found",
            (amount + F.when(is_first, F.coalesce(cents(extra), zero)).otherwise(zero)).alias("gate"),
            amount.alias("weight"),
            F.coalesce(
                cents(F.col("credit_limit") - F.coalesce("_old_balance", F.lit(0))), zero
            ).alias("start"),
            (F.col("account_found") & F.col("amt").isNotNull()).alias("eligible"),
        ),
        "fold_key", ["ts", "req_id"], source=requests, key_counts=lambda: per_key.select("fold_key", "n"), **fold,
    )
    approved, no_funds = F.col("accepted"), F.col("eligible") & ~F.col("accepted")
    card_found = F.col("acct_id").isNotNull()
    return folded.select(
        *requests.columns, "acct_id", "cust_id",
        F.when(approved, "00").otherwise("05").alias("resp_code"),
        auth_reason(
            approved, card_found, F.col("account_found"), F.col("customer_found"), no_funds
        ).alias("resp_reason"),
        F.when(approved, F.col("amt")).otherwise(F.lit(0)).cast(MONEY).alias("approved_amt"),
    )


def details(decided: DataFrame) -> DataFrame:
    """Stored authorizations; nothing is stored for an unknown card."""
    return decided.where(F.col("acct_id").isNotNull()).select(
        "acct_id", F.col("ts").alias("auth_ts"), "req_id", "card_num", "auth_type", "resp_code",
        "resp_reason", F.col("amt").alias("tran_amt"), "approved_amt",
        F.when(F.col("resp_code") == "00", "P").otherwise("D").alias("match_status"),
        F.lit(None).cast("string").alias("fraud_flag"), F.lit(None).cast("date").alias("fraud_date"),
    )


def summaries(stored: DataFrame, accounts: DataFrame) -> DataFrame:
    """Summary per account of its details; limits are the account's, NULL without account."""
    limits = accounts.select("acct_id", "credit_limit", F.col("cash_credit_limit").alias("cash_limit"))
    return A.auth_summary(stored).join(limits, "acct_id", "left").select(
        "acct_id", "credit_limit", "cash_limit",
        F.col("credit_balance").cast(MONEY).alias("credit_balance"),
        F.lit(0).cast(MONEY).alias("cash_balance"), "approved_cnt", "declined_cnt",
        F.col("approved_amt").cast(MONEY).alias("approved_amt"),
        F.col("declined_amt").cast(MONEY).alias("declined_amt"),
    )


def update_summaries(stored: DataFrame, new_details: DataFrame, accounts: DataFrame) -> DataFrame:
    """Stored summaries plus the details of a further run; limits are refreshed from the account."""
    new = summaries(new_details, accounts)
    added = ["credit_balance", "approved_cnt", "declined_cnt", "approved_amt", "declined_amt"]
    limits = ["credit_limit", "cash_limit"]
    fresh = new.select(
        "acct_id", F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in [*limits, *added]]
    )
    merged = stored.join(fresh, "acct_id", "full")
    return merged.select(
        "acct_id",
        *[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in limits],
        F.lit(0).cast(MONEY).alias("cash_balance"),
        *[
            (F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0)))
            .cast(new.schema[c].dataType).alias(c)
            for c in added
        ],
    )


def auth_account_view(
    requests: DataFrame, xref: DataFrame, accounts: DataFrame, customers: DataFrame, summary: DataFrame
) -> DataFrame:
    """Account, customer and authorization summary; zeros when there is no summary."""
    numbers = ["credit_balance", "cash_balance", "approved_cnt", "declined_cnt", "approved_amt", "declined_amt"]
    view = account_view(requests, xref, accounts, customers)
    out = view.join(summary.select("acct_id", *numbers), "acct_id", "left")
    return out.select(
        *view.columns,
        *[F.coalesce(n, F.lit(0)).cast(summary.schema[n].dataType).alias(n) for n in numbers],
    )
