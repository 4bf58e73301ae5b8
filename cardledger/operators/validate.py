"""Rule sets over whole batches: each row gets the array of the rules it fails."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions import dates as D
from cardledger.functions import text as X
from cardledger.functions.money import is_number
from cardledger.operators.joins import with_code_lists

Rules = list[tuple[str, Column]]


def with_errors(df: DataFrame, rules: Rules) -> DataFrame:
    """``rules`` are (name, failed?) pairs; a test that is NULL counts as failed."""
    failed = [F.when(F.coalesce(test, F.lit(True)), F.lit(name)) for name, test in rules]
    return df.withColumn("errors", F.array_compact(F.array(*failed)))


def _missing(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)) == "", F.lit(True))


def _not_yes_no(name: str) -> Column:
    return ~F.coalesce(F.col(name), F.lit("")).isin("Y", "N")


def _bad_date(name: str) -> Column:
    return D.date_rules(F.coalesce(F.col(name), F.lit(""))).isNotNull()


def validate_account_batch(df: DataFrame) -> DataFrame:
    """Text columns of an account update: status, three ``YYYYMMDD`` dates, five amounts."""
    rules: Rules = [("active_status", _not_yes_no("active_status"))]
    rules += [(c, _bad_date(c)) for c in ("open_date", "expiry_date", "reissue_date")]
    amounts = ("credit_limit", "cash_credit_limit", "curr_bal", "cyc_credit", "cyc_debit")
    rules += [(c, ~is_number(F.col(c))) for c in amounts]
    return with_errors(df, rules)


def validate_customer_batch(
    df: DataFrame, asof: dt.date, area_codes: DataFrame | None = None
) -> DataFrame:
    """Customer update: identity, birth date, score, names, address, telephone, account, holder."""
    columns = df.columns
    df = with_code_lists(df, area_codes)
    c = F.col
    state_shape, zip_shape = X.alpha_only(c("state")), X.num_only(c("zip"))
    rules: Rules = [
        ("ssn", ~X.us_ssn(c("ssn"))),
        ("dob", ~(c("dob") < F.lit(asof))),
        ("fico", ~X.fico_range(c("fico"))),
        ("first_name", ~X.alpha_only(c("first_name"))),
        ("middle_name", ~(_missing("middle_name") | X.alpha_only(c("middle_name")))),
        ("last_name", ~X.alpha_only(c("last_name"))),
        ("addr_line_1", _missing("addr_line_1")),
        ("state", ~(state_shape & c("state_ok"))),
        ("zip", ~zip_shape),
        ("city", ~X.alpha_only(c("addr_line_3"))),
        ("country", ~X.alpha_only(c("country"))),
        ("phone_1", ~X.us_phone(c("phone_1"), c("area_1_ok"))),
        ("phone_2", ~X.us_phone(c("phone_2"), c("area_2_ok"))),
        ("eft_account_id", ~X.num_only(c("eft_account_id"))),
        ("primary_holder", _not_yes_no("primary_holder")),
        ("state_zip", state_shape & c("state_ok") & zip_shape & ~c("state_zip_ok")),
    ]
    return with_errors(df, rules).select(*columns, "errors")


def validate_card_batch(df: DataFrame) -> DataFrame:
    """Card update: embossed name, status, expiry month and year as numbers."""
    return with_errors(
        df,
        [
            ("embossed_name", ~X.alpha_only(F.col("embossed_name"))),
            ("active_status", _not_yes_no("active_status")),
            ("expiry_month", ~F.col("expiry_month").between(1, 12)),
            ("expiry_year", ~F.col("expiry_year").between(1950, 2099)),
        ],
    )


def _bad_iso_date(name: str) -> Column:
    return D.date_valid(F.col(name)) != D.DATE_VALID


# Fields that must be supplied in a transaction entry.
TRANSACTION_MANDATORY = [
    "type_cd", "cat_cd", "source", "descr", "amt", "orig_date", "proc_date", "merchant_id",
    "merchant_name", "merchant_city", "merchant_zip",
]


def validate_transaction_batch(df: DataFrame) -> DataFrame:
    """Transaction entry, all text: key, mandatory fields, numbers, amount form, dates."""
    c = F.col
    rules: Rules = [
        ("key missing", _missing("acct_id") & _missing("card_num")),
        ("acct_id", ~(_missing("acct_id") | c("acct_id").rlike("^[0-9]+$"))),
        ("card_num", ~(_missing("card_num") | c("card_num").rlike("^[0-9]+$"))),
    ]
    rules += [(f"{f} missing", _missing(f)) for f in TRANSACTION_MANDATORY]
    rules += [
        (f, ~_missing(f) & ~c(f).rlike("^[0-9]+$")) for f in ("type_cd", "cat_cd", "merchant_id")
    ]
    rules += [("amt", ~_missing("amt") & ~c("amt").rlike(r"^[+-][0-9]{8}\.[0-9]{2}$"))]
    rules += [(f, ~_missing(f) & _bad_iso_date(f)) for f in ("orig_date", "proc_date")]
    return with_errors(df, rules)


def validate_user_batch(df: DataFrame) -> DataFrame:
    """User entry: first name, last name, id and type are mandatory."""
    fields = ("first_name", "last_name", "user_id", "user_type")
    return with_errors(df, [(f, _missing(f)) for f in fields])
