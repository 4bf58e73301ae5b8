"""Lookups between transactions, cards, accounts, customers and code tables.

No join hints: Spark broadcasts a side only when its size statistics are below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with AQE splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.codes import AREA_CODES, STATE_ZIP, read_codes
from cardledger.literals import literal_table


def join_xref(tx: DataFrame, xref: DataFrame) -> DataFrame:
    """Transactions with the account and customer of their card; unknown cards drop out."""
    return tx.join(xref.select("card_num", "acct_id", "cust_id"), "card_num")


def unknown_cards(tx: DataFrame, xref: DataFrame) -> DataFrame:
    return tx.join(xref.select("card_num"), "card_num", "left_anti")


def unknown_accounts(tx: DataFrame, xref: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions whose card is known but whose account is not."""
    return join_xref(tx, xref).join(accounts.select("acct_id"), "acct_id", "left_anti")


def card_facts(xref: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per card: account, customer, the account's columns and ``account_found``.

    The masters are joined with each other first, so that the much larger transaction side is
    looked up, and shuffled, once.
    """
    found = F.coalesce("account_found", F.lit(False)).alias("account_found")
    facts = accounts.withColumn("account_found", F.lit(True))
    return xref.join(facts, "acct_id", "left").select(
        *xref.columns, *[c for c in accounts.columns if c != "acct_id"], found
    )


def with_card_account(tx: DataFrame, xref: DataFrame, accounts: DataFrame, seq: str) -> DataFrame:
    """Left-join card and account; adds ``acct_id``, ``account_found`` and ``fold_key``.

    ``fold_key`` is the account, or a negative number of the row's own when the card is unknown,
    so unknown cards do not meet in one null partition.
    """
    cards = xref.select("card_num", "acct_id", "cust_id")
    joined = tx.join(card_facts(cards, accounts), "card_num", "left")
    return joined.withColumns(
        {
            "fold_key": F.coalesce("acct_id", -1 - F.col(seq)),
            "account_found": F.coalesce("account_found", F.lit(False)),
        }
    )


def verify_daily(tx: DataFrame, xref: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per transaction: is the card known, is its account found."""
    out = with_card_account(tx, xref, accounts.select("acct_id"), "seq")
    return out.select(
        *tx.columns, "acct_id", F.col("cust_id").isNotNull().alias("card_verified"), "account_found"
    )


def with_report_dimensions(
    tx: DataFrame, xref: DataFrame, types: DataFrame, categories: DataFrame
) -> DataFrame:
    """Account, type and category descriptions; ``lookup_failed`` names the first missing one."""
    out = (
        tx.join(xref.select("card_num", "acct_id", F.lit(True).alias("_card")), "card_num", "left")
        .join(types.select("type_cd", "type_desc"), "type_cd", "left")
        .join(categories.select("type_cd", "cat_cd", "cat_desc"), ["type_cd", "cat_cd"], "left")
    )
    failed = (
        F.when(F.col("_card").isNull(), "card")
        .when(F.col("type_desc").isNull(), "type")
        .when(F.col("cat_desc").isNull(), "category")
    )
    return out.withColumn("lookup_failed", failed).drop("_card")


def require_lookups(df: DataFrame) -> DataFrame:
    """Raise when a row has ``lookup_failed`` set (strict runs), naming a few of them."""
    bad = df.where(F.col("lookup_failed").isNotNull()).limit(5).collect()
    if bad:
        raise LookupError("; ".join(f"{r['lookup_failed']} missing: {r.asDict()}" for r in bad))
    return df


def join_rate_with_default(balances: DataFrame, rates: DataFrame, default: str = "DEFAULT") -> DataFrame:
    """Rate of (group, type, category), else of the default group."""
    own = rates.select("group_id", "type_cd", "cat_cd", F.col("rate").alias("_own"))
    fallback = rates.where(F.col("group_id") == default).select(
        "type_cd", "cat_cd", F.col("rate").alias("_fallback")
    )
    return (
        balances.join(own, ["group_id", "type_cd", "cat_cd"], "left")
        .join(fallback, ["type_cd", "cat_cd"], "left")
        .withColumn("rate", F.coalesce("_own", "_fallback"))
        .drop("_own", "_fallback")
    )


def first_card(xref: DataFrame) -> DataFrame:
    """Lowest card number of each account."""
    return xref.groupBy("acct_id").agg(F.min("card_num").alias("card_num"))


def account_view(
    requests: DataFrame, xref: DataFrame, accounts: DataFrame, customers: DataFrame
) -> DataFrame:
    """Account id to card, account and customer, with the first hop that found nothing.

    An account with several cards is shown once, with its lowest card number.
    """
    cards = xref.groupBy("acct_id").agg(F.min(F.struct("card_num", "cust_id")).alias("x"))
    cards = cards.select("acct_id", "x.card_num", "x.cust_id")
    out = (
        requests.join(cards, "acct_id", "left")
        .join(accounts.withColumn("_acct", F.lit(True)), "acct_id", "left")
        .join(customers.withColumn("_cust", F.lit(True)), "cust_id", "left")
    )
    reason = (
        F.when(F.col("card_num").isNull(), "account not in cross reference")
        .when(F.col("_acct").isNull(), "account not in account master")
        .when(F.col("_cust").isNull(), "customer not in customer master")
    )
    return out.withColumn("not_found", reason).drop("_acct", "_cust")


def lookup(requests: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Request keys to rows; ``found`` is false where the key is unknown."""
    out = requests.join(table.withColumn("found", F.lit(True)), keys, "left")
    return out.withColumn("found", F.coalesce("found", F.lit(False)))


# Decline reason codes and texts.
DECLINE_REASONS = [
    ("0000", "APPROVED"), ("3100", "INVALID CARD"), ("4100", "INSUFFICNT FUND"),
    ("4200", "CARD NOT ACTIVE"), ("4300", "ACCOUNT CLOSED"), ("4400", "EXCED DAILY LMT"),
    ("5100", "CARD FRAUD"), ("5200", "MERCHANT FRAUD"), ("5300", "LOST CARD"), ("9000", "UNKNOWN"),
]


def with_decline_reason(df: DataFrame, code: str = "resp_reason") -> DataFrame:
    """Add ``reason_text`` as ``code-description``; an unknown code gives ``9999-ERROR``."""
    reasons = literal_table(df.sparkSession, DECLINE_REASONS, {code: "STRING", "_text": "STRING"})
    return df.join(reasons, code, "left").withColumn(
        "reason_text", F.coalesce(F.concat(F.col(code), F.lit("-"), F.col("_text")), F.lit("9999-ERROR"))
    ).drop("_text")


# State and territory codes.
STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM "
    "NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC AS GU MP PR VI"
).split()

def with_code_lists(
    df: DataFrame, area_codes: DataFrame | None = None, state_zip: DataFrame | None = None
) -> DataFrame:
    """Flag membership in the code lists: ``state_ok``, ``state_zip_ok``, ``area_1_ok``, ``area_2_ok``.

    ``area_codes`` (``area_code``) and ``state_zip`` (``state``, ``zip2``) replace the lists that
    come with the library.
    """
    spark = df.sparkSession
    states = literal_table(spark, [(s, "true") for s in STATES], {"state": "STRING", "_state": "BOOLEAN"})
    if state_zip is None:
        state_zip = literal_table(spark, read_codes(STATE_ZIP), {"state": "STRING", "zip2": "STRING"})
    if area_codes is None:
        area_codes = literal_table(spark, read_codes(AREA_CODES), {"area_code": "STRING"})
    pairs = state_zip.select("state", F.col("zip2").alias("_zip2"), F.lit(True).alias("_pair"))
    out = (
        df.withColumn("_zip2", F.substring("zip", 1, 2))
        .join(states, "state", "left")
        .join(pairs, ["state", "_zip2"], "left")
    )
    for i in (1, 2):
        area = F.regexp_extract(F.rtrim(f"phone_{i}"), r"^\(([0-9]{3})\)", 1)
        listed = area_codes.select(F.col("area_code").alias("_area"), F.lit(True).alias(f"area_{i}_ok")).distinct()
        out = out.withColumn("_area", area).join(listed, "_area", "left").drop("_area")
        out = out.withColumn(f"area_{i}_ok", F.coalesce(f"area_{i}_ok", F.lit(False)))
    return out.select(
        *df.columns,
        F.coalesce("_state", F.lit(False)).alias("state_ok"),
        F.coalesce("_pair", F.lit(False)).alias("state_zip_ok"),
        "area_1_ok", "area_2_ok",
    )


def parents_with_children(parents: DataFrame, children: DataFrame, key: str = "acct_id") -> DataFrame:
    return parents.join(children, key)


def orphan_children(children: DataFrame, parents: DataFrame, key: str = "acct_id") -> DataFrame:
    return children.join(parents.select(key), key, "left_anti")


def restrict_delete(
    deletes: DataFrame, children: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """Split delete requests into allowed ones and ones blocked by child rows."""
    used = children.select(key)
    return deletes.join(used, key, "left_anti"), deletes.join(used, key, "left_semi")
