"""Daily posting: validate, reject or post, and carry the effects into the masters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.functions.money import cents
from cardledger.operators import aggregates as A
from cardledger.operators.changes import apply_posting, upsert_category_balance
from cardledger.operators.headroom import fold_in_order
from cardledger.operators.joins import with_card_account
from cardledger.session import materialize
from cardledger.sources.snapshots import publish, snapshot_write

# Reject reasons.
REASONS = {
    100: "INVALID CARD NUMBER FOUND",
    101: "ACCOUNT RECORD NOT FOUND",
    102: "OVERLIMIT TRANSACTION",
    103: "TRANSACTION RECEIVED AFTER ACCT EXPIRATION",
}


def decide(tx: DataFrame, xref: DataFrame, accounts: DataFrame, **fold: int) -> DataFrame:
    """Give every daily transaction its ``reason`` (0 = accepted), in input order per account.

    Tested value = cycle credit - cycle debit + amount.  Accepted negative amounts are added to
    the debit, which so holds a negative sum; both kinds of accepted amount therefore raise the
    tested value by their size.  In headroom terms: gate = amount, weight = its size.
    The expiry test does not depend on earlier rows and wins over the limit test.
    """
    facts = accounts.select("acct_id", "credit_limit", "expiry_date", "cyc_credit", "cyc_debit")
    joined = with_card_account(tx, xref, facts, "seq")
    live = F.col("account_found") & (F.col("expiry_date") >= F.col("orig_date"))
    zero = F.lit(0).cast("bigint")
    rows = joined.select(
        *tx.columns, "acct_id", "fold_key", "account_found",
        F.coalesce(cents(F.col("amt")), zero).alias("gate"),
        F.coalesce(F.abs(cents(F.col("amt"))), zero).alias("weight"),
        F.coalesce(
            cents(F.col("credit_limit") - F.col("cyc_credit") + F.col("cyc_debit")), zero
        ).alias("start"),
        F.coalesce(live, F.lit(False)).alias("eligible"),
    )

    def key_counts() -> DataFrame:
        # Rows per card first, so that a hot card is one row in the join with the cross reference.
        per_card = tx.groupBy("card_num").agg(F.count("*").alias("_n"))
        return (
            per_card.join(xref.select("card_num", "acct_id"), "card_num")
            .groupBy(F.col("acct_id").alias("fold_key"))
            .agg(F.sum("_n").alias("n"))
        )

    folded = fold_in_order(rows, "fold_key", ["seq"], source=tx, key_counts=key_counts, **fold)
    reason = (
        F.when(F.col("acct_id").isNull(), 100)
        .when(~F.col("account_found"), 101)
        .when(~F.col("eligible"), 103)
        .when(~F.col("accepted"), 102)
        .otherwise(0)
    )
    return folded.select(*tx.columns, "acct_id", reason.cast("int").alias("reason"))


def posted_rows(decisions: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Ledger rows of the accepted transactions, stamped with the run time."""
    return (
        decisions.where(F.col("reason") == 0)
        .drop("reason")
        .withColumn("proc_ts", F.lit(run_ts).cast("timestamp"))
    )


def reject_rows(decisions: DataFrame) -> DataFrame:
    """Rejected input with reason code and text."""
    text = F.create_map(*[F.lit(v) for kv in REASONS.items() for v in kv])
    return decisions.where(F.col("reason") != 0).withColumn("reason_text", text[F.col("reason")])


@dataclass
class Posting:
    decisions: DataFrame
    ledger: DataFrame
    rejects: DataFrame
    counts: DataFrame
    category_balances: DataFrame
    accounts: DataFrame


def post_daily(
    tx: DataFrame,
    xref: DataFrame,
    accounts: DataFrame,
    category_balances: DataFrame,
    run_ts: dt.datetime,
    store: bool = True,
) -> Posting:
    """The whole job.  With ``store`` the decisions are computed once and feed all outputs."""
    decisions = decide(tx, xref, accounts)
    if store:
        decisions = materialize(decisions)
    ledger = posted_rows(decisions, run_ts)
    return Posting(
        decisions=decisions,
        ledger=ledger,
        rejects=reject_rows(decisions),
        counts=A.posting_counts(decisions),
        category_balances=upsert_category_balance(category_balances, A.category_balance(ledger)),
        accounts=apply_posting(accounts, A.cycle_amounts(ledger)),
    )


OUTPUTS = {
    "ledger": lambda job: job.ledger, "rejects": lambda job: job.rejects,
    "category_balances": lambda job: job.category_balances, "accounts": lambda job: job.accounts,
}


def write_posting(job: Posting, root: str, keep: int = 5) -> dict[str, int]:
    """Write the outputs as the next snapshots below ``root``; none is current before all are there."""
    spark = job.decisions.sparkSession
    versions = {
        name: snapshot_write(pick(job), f"{root}/{name}", keep, publish_now=False)
        for name, pick in OUTPUTS.items()
    }
    for name, version in versions.items():
        publish(spark, f"{root}/{name}", version, keep)
    return versions
