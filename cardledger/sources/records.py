"""Fixed-length binary records: exchange records and unloaded authorization segments.

Numbers are decoded by column expressions.  Text is ASCII or, for ``charset='cp037'``, EBCDIC,
which Spark's own ``decode`` does not accept; a small Arrow-batched function turns those bytes
into text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger import schemas
from cardledger.functions import decode
from cardledger.functions.dates import real_date
from cardledger.functions.text import blank_to_null, fits
from cardledger.schemas import Field, Layout
from cardledger.sources.exchange import TAGS


def _fields(*rows: tuple) -> tuple[Field, ...]:
    return tuple(Field(*r) for r in rows)


# Record layouts (name, start, length in bytes, kind, scale).
EXPORT_HEADER = Layout("header", 40, _fields(
    ("rec_type", 1, 1), ("run_ts", 2, 26), ("seq_num", 28, 4, "binary"), ("branch_id", 32, 4),
    ("region_code", 36, 5),
))
EXPORT_BODIES = {
    "customer": Layout("customer", 460, _fields(
        ("cust_id", 1, 4, "binary"), ("first_name", 5, 25), ("middle_name", 30, 25),
        ("last_name", 55, 25), ("addr_line_1", 80, 50), ("addr_line_2", 130, 50),
        ("addr_line_3", 180, 50), ("state", 230, 2), ("country", 232, 3), ("zip", 235, 10),
        ("phone_1", 245, 15), ("phone_2", 260, 15), ("ssn", 275, 9), ("govt_id", 284, 20),
        ("dob", 304, 10, "date"), ("eft_account_id", 314, 10), ("primary_holder", 324, 1),
        ("fico", 325, 2, "packed"),
    )),
    "account": Layout("account", 460, _fields(
        ("acct_id", 1, 11, "integer"), ("active_status", 12, 1), ("curr_bal", 13, 7, "packed", 2),
        ("credit_limit", 20, 12, "zoned", 2), ("cash_credit_limit", 32, 7, "packed", 2),
        ("open_date", 39, 10, "date"), ("expiry_date", 49, 10, "date"),
        ("reissue_date", 59, 10, "date"), ("cyc_credit", 69, 12, "zoned", 2),
        ("cyc_debit", 81, 8, "binary", 2), ("zip", 89, 10), ("group_id", 99, 10),
    )),
    "transaction": Layout("transaction", 460, _fields(
        ("tran_id", 1, 16), ("type_cd", 17, 2), ("cat_cd", 19, 4, "integer"), ("source", 23, 10),
        ("descr", 33, 100), ("amt", 133, 6, "packed", 2), ("merchant_id", 139, 4, "binary"),
        ("merchant_name", 143, 50), ("merchant_city", 193, 50), ("merchant_zip", 243, 10),
        ("card_num", 253, 16), ("orig_ts", 269, 26), ("proc_ts", 295, 26),
    )),
    "xref": Layout("xref", 460, _fields(
        ("card_num", 1, 16), ("cust_id", 17, 9, "integer"), ("acct_id", 26, 8, "binary"),
    )),
    "card": Layout("card", 460, _fields(
        ("card_num", 1, 16), ("acct_id", 17, 8, "binary"), ("cvv", 25, 2, "binary"),
        ("embossed_name", 27, 50), ("expiry_date", 77, 10, "date"), ("active_status", 87, 1),
    )),
}
AUTH_SUMMARY_SEGMENT = Layout("auth_summary", 100, _fields(
    ("acct_id", 1, 6, "packed"), ("cust_id", 7, 9, "integer"), ("auth_status", 16, 1),
    ("account_status_1", 17, 2), ("account_status_2", 19, 2), ("account_status_3", 21, 2),
    ("account_status_4", 23, 2), ("account_status_5", 25, 2), ("credit_limit", 27, 6, "packed", 2),
    ("cash_limit", 33, 6, "packed", 2), ("credit_balance", 39, 6, "packed", 2),
    ("cash_balance", 45, 6, "packed", 2), ("approved_cnt", 51, 2, "binary"),
    ("declined_cnt", 53, 2, "binary"), ("approved_amt", 55, 6, "packed", 2),
    ("declined_amt", 61, 6, "packed", 2),
))
AUTH_DETAIL_SEGMENT = Layout("auth_detail", 200, _fields(
    ("day_key", 1, 3, "packed"), ("time_key", 4, 5, "packed"), ("orig_date", 9, 6),
    ("orig_time", 15, 6), ("card_num", 21, 16), ("auth_type", 37, 4), ("card_expiry_date", 41, 4),
    ("message_type", 45, 6), ("message_source", 51, 6), ("auth_id_code", 57, 6),
    ("resp_code", 63, 2), ("resp_reason", 65, 4), ("processing_code", 69, 6),
    ("tran_amt", 75, 7, "packed", 2), ("approved_amt", 82, 7, "packed", 2),
    ("merchant_category_code", 89, 4), ("acqr_country_code", 93, 3), ("pos_entry_mode", 96, 2),
    ("merchant_id", 98, 15), ("merchant_name", 113, 22), ("merchant_city", 135, 13),
    ("merchant_state", 148, 2), ("merchant_zip", 150, 9), ("transaction_id", 159, 15),
    ("match_status", 174, 1), ("fraud_flag", 175, 1), ("fraud_date", 176, 8),
))


_ENTITIES = {
    "customer": schemas.CUSTOMER, "account": schemas.ACCOUNT, "transaction": schemas.TRANSACTION,
    "xref": schemas.XREF, "card": schemas.CARD,
}


# The code page maps each byte to one character, so a byte read as Latin-1 only needs translating;
# zero is itself in both.
_LATIN = bytes(range(1, 256)).decode("latin-1")
_EBCDIC = bytes(range(1, 256)).decode("cp037")


def ebcdic_text(raw: Column) -> Column:
    return F.translate(F.decode(raw, "ISO-8859-1"), _LATIN, _EBCDIC)


def ebcdic_bytes(text: Column) -> Column:
    return F.encode(F.translate(text, _EBCDIC, _LATIN), "ISO-8859-1")


def _text(raw: Column, charset: str) -> Column:
    return ebcdic_text(raw) if charset == "cp037" else F.decode(raw, "US-ASCII")


def _value(record: Column, field: Field, base: int, charset: str) -> Column:
    raw = F.substring(record, base + field.start, field.length)
    if field.kind == "packed":
        if field.scale:
            return decode.decode_packed(raw, field.scale, 2 * field.length - 1)
        return decode.decode_packed(raw, 0).cast("bigint")
    if field.kind == "binary":
        return decode.decode_binary(raw, field.length, field.scale)
    text = _text(raw, charset)
    if field.kind == "zoned":
        return decode.decode_zoned(text, field.scale, field.length)
    if field.kind == "integer":
        return F.trim(text).try_cast("bigint")
    if field.kind == "date":
        return real_date(F.trim(text))
    return blank_to_null(text)


def parse_records(
    records: DataFrame,
    layout: Layout,
    column: str = "record",
    base: int = 0,
    charset: str = "US-ASCII",
    schema: T.StructType | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Binary records to typed columns; ``base`` bytes in front of the layout are skipped, and the
    columns named in ``keep`` stay.

    Numbers get the types of ``schema`` where it names them.
    """
    def typed(field: Field) -> Column:
        value = _value(F.col(column), field, base, charset)
        if schema is not None and field.name in schema.names and field.kind not in ("text", "date"):
            value = value.cast(schema[field.name].dataType)
        return value.alias(field.name)

    return records.select(*(keep or []), *[typed(f) for f in layout.fields])


def import_records(records: DataFrame, column: str = "record", charset: str = "US-ASCII") -> dict[str, DataFrame]:
    """500-byte exchange records to the typed tables, and ``errors`` for unknown tags."""
    tag = _text(F.substring(column, 1, 1), charset)
    tagged = records.withColumn("_tag", tag)
    out = {
        name: parse_records(
            tagged.where(F.col("_tag") == code), EXPORT_BODIES[name], column,
            EXPORT_HEADER.length, charset, _ENTITIES[name],
        )
        for code, name in TAGS.items()
    }
    unknown = tagged.where(~F.coalesce(F.col("_tag").isin(*TAGS), F.lit(False)))
    out["errors"] = parse_records(unknown, EXPORT_HEADER, column, 0, charset)
    return out


def _bytes(field: Field, charset: str) -> Column:
    col = F.col(f"`{field.name}`")
    if field.kind == "packed":
        return decode.encode_packed(F.coalesce(col, F.lit(0)), 2 * field.length - 1, field.scale)
    if field.kind == "binary":
        return decode.encode_binary(F.coalesce(col, F.lit(0)), field.length, field.scale)
    if field.kind == "zoned":
        text = decode.encode_zoned(F.coalesce(col, F.lit(0)), field.length, field.scale)
    elif field.kind == "integer":
        text = fits(F.coalesce(col, F.lit(0)).cast("string"), field.length, field.name)
        text = F.lpad(text, field.length, "0")
    else:
        text = fits(F.coalesce(col.cast("string"), F.lit("")), field.length, field.name)
        text = F.rpad(text, field.length, " ")
    return ebcdic_bytes(text) if charset == "cp037" else F.encode(text, "US-ASCII")


def render_records(df: DataFrame, layout: Layout, charset: str = "US-ASCII") -> Column:
    """The record of ``layout`` as one binary column of ``df``; the rest is blank."""
    parts: list[Column] = []
    at = 1
    blank = b"\x40" if charset == "cp037" else b" "
    for field in layout.fields:
        parts.append(_bytes(field, charset))
        at = field.start + field.length
    if at <= layout.length:
        parts.append(F.unhex(F.lit((blank * (layout.length - at + 1)).hex())))
    return F.concat(*parts)


def export_records(export: DataFrame, name: str, charset: str = "US-ASCII") -> DataFrame:
    """500-byte records of one kind of an export (``record``), in its typed columns' layout."""
    tag = next(code for code, table in TAGS.items() if table == name)
    head = export.where(F.col("rec_type") == tag).select("rec_type", "run_ts", "seq_num", "branch_id", "region_code", f"{name}.*")
    head = head.select(*head.columns, *[
        F.lit(None).alias(f.name) for f in EXPORT_BODIES[name].fields if f.name not in head.columns
    ])
    body = render_records(head, EXPORT_BODIES[name], charset)
    return head.select(F.concat(render_records(head, EXPORT_HEADER, charset), body).alias("record"))
