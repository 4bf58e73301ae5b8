"""Entity schemas and fixed-width record layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
TRAN_MONEY = T.DecimalType(11, 2)
RATE = T.DecimalType(6, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _L, _I, _D, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.DateType(), T.TimestampType()

ACCOUNT = _schema(
    ("acct_id", _L), ("active_status", _S), ("curr_bal", MONEY), ("credit_limit", MONEY),
    ("cash_credit_limit", MONEY), ("open_date", _D), ("expiry_date", _D), ("reissue_date", _D),
    ("cyc_credit", MONEY), ("cyc_debit", MONEY), ("zip", _S), ("group_id", _S),
)
CARD = _schema(
    ("card_num", _S), ("acct_id", _L), ("cvv", _I), ("embossed_name", _S),
    ("expiry_date", _D), ("active_status", _S),
)
XREF = _schema(("card_num", _S), ("cust_id", _L), ("acct_id", _L))
CUSTOMER = _schema(
    ("cust_id", _L), ("first_name", _S), ("middle_name", _S), ("last_name", _S),
    ("addr_line_1", _S), ("addr_line_2", _S), ("addr_line_3", _S), ("state", _S),
    ("country", _S), ("zip", _S), ("phone_1", _S), ("phone_2", _S), ("ssn", _S),
    ("govt_id", _S), ("dob", _D), ("eft_account_id", _S), ("primary_holder", _S), ("fico", _I),
)
TRANSACTION = _schema(
    ("tran_id", _S), ("type_cd", _S), ("cat_cd", _I), ("source", _S), ("desc", _S),
    ("amt", TRAN_MONEY), ("merchant_id", _L), ("merchant_name", _S), ("merchant_city", _S),
    ("merchant_zip", _S), ("card_num", _S), ("orig_ts", _TS), ("proc_ts", _TS),
)
CATEGORY_BALANCE = _schema(("acct_id", _L), ("type_cd", _S), ("cat_cd", _I), ("balance", TRAN_MONEY))
DISCLOSURE_RATE = _schema(("group_id", _S), ("type_cd", _S), ("cat_cd", _I), ("rate", RATE))
TRAN_TYPE = _schema(("type_cd", _S), ("type_desc", _S))
TRAN_CATEGORY = _schema(("type_cd", _S), ("cat_cd", _I), ("cat_desc", _S))
APP_USER = _schema(("user_id", _S), ("first_name", _S), ("last_name", _S), ("user_type", _S))
AUTH_SUMMARY = _schema(
    ("acct_id", _L), ("cust_id", _L), ("credit_limit", MONEY), ("cash_limit", MONEY),
    ("credit_balance", MONEY), ("cash_balance", MONEY), ("approved_cnt", _L),
    ("declined_cnt", _L), ("approved_amt", MONEY), ("declined_amt", MONEY),
)
AUTH_DETAIL = _schema(
    ("acct_id", _L), ("auth_ts", _TS), ("req_id", _L), ("card_num", _S), ("auth_type", _S),
    ("resp_code", _S), ("resp_reason", _S), ("tran_amt", MONEY), ("approved_amt", MONEY),
    ("match_status", _S), ("fraud_flag", _S), ("fraud_date", _D),
)

#: Field order of the comma-separated authorization request (fixed values of the message format).
AUTH_REQUEST_FIELDS = [
    "auth_date", "auth_time", "card_num", "auth_type", "card_expiry_date", "message_type",
    "message_source", "processing_code", "transaction_amt", "merchant_category_code",
    "acqr_country_code", "pos_entry_mode", "merchant_id", "merchant_name", "merchant_city",
    "merchant_state", "merchant_zip", "transaction_id",
]


@dataclass(frozen=True)
class Field:
    """One field of a fixed-width record; ``start`` counts from 1."""

    name: str
    start: int
    length: int
    kind: str = "text"  # text | digits | integer | zoned | date | timestamp
    scale: int = 0


@dataclass(frozen=True)
class Layout:
    name: str
    length: int
    fields: tuple[Field, ...]


def _layout(name: str, length: int, *fields: tuple) -> Layout:
    return Layout(name, length, tuple(Field(*f) for f in fields))


# Record layouts of the flat files (name, start, length, kind, scale).
ACCOUNT_FILE = _layout(
    "account", 300,
    ("acct_id", 1, 11, "integer"), ("active_status", 12, 1), ("curr_bal", 13, 12, "zoned", 2),
    ("credit_limit", 25, 12, "zoned", 2), ("cash_credit_limit", 37, 12, "zoned", 2),
    ("open_date", 49, 10, "date"), ("expiry_date", 59, 10, "date"),
    ("reissue_date", 69, 10, "date"), ("cyc_credit", 79, 12, "zoned", 2),
    ("cyc_debit", 91, 12, "zoned", 2), ("zip", 103, 10), ("group_id", 113, 10),
)
CARD_FILE = _layout(
    "card", 150,
    ("card_num", 1, 16), ("acct_id", 17, 11, "integer"), ("cvv", 28, 3, "integer"),
    ("embossed_name", 31, 50), ("expiry_date", 81, 10, "date"), ("active_status", 91, 1),
)
XREF_FILE = _layout(
    "xref", 50,
    ("card_num", 1, 16), ("cust_id", 17, 9, "integer"), ("acct_id", 26, 11, "integer"),
)
CUSTOMER_FILE = _layout(
    "customer", 500,
    ("cust_id", 1, 9, "integer"), ("first_name", 10, 25), ("middle_name", 35, 25),
    ("last_name", 60, 25), ("addr_line_1", 85, 50), ("addr_line_2", 135, 50),
    ("addr_line_3", 185, 50), ("state", 235, 2), ("country", 237, 3), ("zip", 240, 10),
    ("phone_1", 250, 15), ("phone_2", 265, 15), ("ssn", 280, 9), ("govt_id", 289, 20),
    ("dob", 309, 10, "date"), ("eft_account_id", 319, 10), ("primary_holder", 329, 1),
    ("fico", 330, 3, "integer"),
)
RATE_FILE = _layout(
    "rate", 50,
    ("group_id", 1, 10), ("type_cd", 11, 2), ("cat_cd", 13, 4, "integer"),
    ("rate", 17, 6, "zoned", 2),
)
CATEGORY_BALANCE_FILE = _layout(
    "category_balance", 50,
    ("acct_id", 1, 11, "integer"), ("type_cd", 12, 2), ("cat_cd", 14, 4, "integer"),
    ("balance", 18, 11, "zoned", 2),
)
TRAN_CATEGORY_FILE = _layout(
    "tran_category", 60, ("type_cd", 1, 2), ("cat_cd", 3, 4, "integer"), ("cat_desc", 7, 50),
)
TRAN_TYPE_FILE = _layout("tran_type", 60, ("type_cd", 1, 2), ("type_desc", 3, 50))
TRANSACTION_FILE = _layout(
    "transaction", 350,
    ("tran_id", 1, 16), ("type_cd", 17, 2), ("cat_cd", 19, 4, "integer"), ("source", 23, 10),
    ("desc", 33, 100), ("amt", 133, 11, "zoned", 2), ("merchant_id", 144, 9, "integer"),
    ("merchant_name", 153, 50), ("merchant_city", 203, 50), ("merchant_zip", 253, 10),
    ("card_num", 263, 16), ("orig_ts", 279, 26, "timestamp"), ("proc_ts", 305, 26, "timestamp"),
)
APP_USER_FILE = _layout(
    "app_user", 80,
    ("user_id", 1, 8), ("first_name", 9, 20), ("last_name", 29, 20), ("user_type", 57, 1),
)
