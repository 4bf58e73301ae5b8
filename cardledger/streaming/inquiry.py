"""Account inquiry: request stream to reply stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.session import materialize

# The function code and the reply to a request that cannot be served.
INQUIRY = "INQA"
INVALID = "INVALID REQUEST PARAMETERS "


def account_inquiry_stream(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Requests (``req_id``, ``func``, ``acct_key``) to account fields or an invalid-request text."""
    asked = (F.col("func") == INQUIRY) & (F.col("acct_key") > 0)
    key = F.when(asked, F.col("acct_key")).otherwise(-1 - F.col("req_id"))
    facts = accounts.withColumn("_k", F.col("acct_id"))
    if requests.isStreaming:  # read once, and merged: a broadcast would pass the driver with each micro-batch
        facts = materialize(facts, "account-facts").hint("merge")
    out = requests.withColumn("_k", key).join(facts, "_k", "left").drop("_k")
    number = F.lpad(F.col("acct_key").cast("string"), 11, "0")
    text = F.when(
        F.col("acct_id").isNull(),
        F.concat(
            F.lit(INVALID + "ACCT ID : "), number,
            F.when(asked, F.lit("")).otherwise(F.concat(F.lit("FUNCTION : "), F.col("func"))),
        ),
    )
    return out.withColumn("message", text)
