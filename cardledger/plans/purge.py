"""Purge of expired authorizations."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.operators.aggregates import auth_summary
from cardledger.operators.filters import expired


@dataclass
class Purge:
    details: DataFrame
    summaries: DataFrame
    counts: DataFrame


def purge_summaries(
    summaries: DataFrame, details: DataFrame, asof: dt.date, days: int, release_credit: bool = False
) -> DataFrame:
    """All summaries after taking off the expired details, with ``deleted``.

    A summary with no approved and no declined authorization left is deleted.  The credit balance
    stays as it is unless ``release_credit``.
    """
    gone = auth_summary(details.where(expired(details, asof, days)))
    gone = gone.select("acct_id", *[F.col(c).alias(f"_{c}") for c in gone.columns if c != "acct_id"])
    changed = ["approved_cnt", "declined_cnt", "approved_amt", "declined_amt"]
    changed += ["credit_balance"] if release_credit else []
    after = summaries.join(gone, "acct_id", "left").select(
        *[
            (F.col(c) - F.coalesce(f"_{c}", F.lit(0))).cast(summaries.schema[c].dataType).alias(c)
            if c in changed
            else F.col(c)
            for c in summaries.columns
        ]
    )
    return after.withColumn(
        "deleted", (F.col("approved_cnt") <= 0) & (F.col("declined_cnt") <= 0)
    )


def purge_auth(
    summaries: DataFrame, details: DataFrame, asof: dt.date, days: int = 5, release_credit: bool = False
) -> Purge:
    """Details younger than ``days``, the remaining summaries, and counts of read and deleted rows.

    A deleted summary takes its remaining details with it.
    """
    judged = purge_summaries(summaries, details, asof, days, release_credit)
    kept = judged.where(~F.col("deleted")).drop("deleted")
    left = details.where(~expired(details, asof, days)).join(kept.select("acct_id"), "acct_id", "left_semi")
    counts = (
        judged.select("deleted", F.lit("s").alias("_t"))
        .unionByName(details.select(expired(details, asof, days).alias("deleted"), F.lit("d").alias("_t")))
        .agg(
            F.count_if(F.col("_t") == "s").alias("summaries_read"),
            F.count_if((F.col("_t") == "s") & F.col("deleted")).alias("summaries_deleted"),
            F.count_if(F.col("_t") == "d").alias("details_read"),
            F.count_if((F.col("_t") == "d") & F.col("deleted")).alias("details_deleted"),
        )
    )
    return Purge(details=left, summaries=kept, counts=counts)
