"""Authorization request and reply messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.functions.money import edit_amount, numval
from cardledger.functions.text import blank_to_null, tokens
from cardledger.schemas import AUTH_REQUEST_FIELDS


def auth_request_source(lines: DataFrame, column: str = "value") -> DataFrame:
    """Comma-separated request lines to columns, for batches and streams alike.

    ``amt`` is the number in the amount field (NULL when it is none); other columns of ``lines``
    stay in front.
    """
    fields = [blank_to_null(c).alias(n) for c, n in zip(tokens(F.col(column), AUTH_REQUEST_FIELDS), AUTH_REQUEST_FIELDS)]
    others = [c for c in lines.columns if c != column]
    parsed = lines.select(*others, *fields)
    return parsed.withColumn("amt", numval(F.col("transaction_amt"), 12, 2)).drop("transaction_amt")


def requests_from_messages(parsed: DataFrame) -> DataFrame:
    """Parsed messages (with ``req_id``) as requests: time of the message, its time as id code."""
    stamp = F.try_to_timestamp(F.concat("auth_date", "auth_time"), F.lit("yyMMddHHmmss"))
    return parsed.select(
        "req_id", stamp.alias("ts"), "card_num", "auth_type", "amt", "transaction_id",
        F.col("auth_time").alias("auth_id_code"),
    )


def auth_reply_lines(decided: DataFrame) -> DataFrame:
    """Reply line per decided request: card, transaction, id code, response, reason, amount."""
    reply = F.concat(
        F.concat_ws(
            ",", F.rpad("card_num", 16, " "), F.rpad("transaction_id", 15, " "),
            F.rpad(F.coalesce("auth_id_code", F.lit("")), 6, " "), F.col("resp_code"),
            F.col("resp_reason"), edit_amount(F.col("approved_amt"), "+9(10).99"),
        ),
        F.lit(","),
    )
    return decided.select(F.col("req_id").alias("correlation_id"), reply.alias("value"))
