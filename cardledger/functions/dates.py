"""Dates: reformatting, validity classes, calendar rules, descending keys."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def date_reformat(col: Column, from_kind: str, to_kind: str) -> Column:
    """Move digits between ``YYYYMMDD`` (kind '1' in) and ``YYYY-MM-DD`` (kind '2' in).

    ``to_kind`` '1' is the dashed form and '2' the plain one.  A pair that does not change the
    form is an invalid selection.
    """
    if (from_kind, to_kind) == ("1", "1"):
        return F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2))
    if (from_kind, to_kind) == ("2", "2"):
        return F.concat(F.substring(col, 1, 4), F.substring(col, 6, 2), F.substring(col, 9, 2))
    raise ValueError("INVALID INPUT")


# Result texts of the date check.
DATE_VALID = "Date is valid"
DATE_INSUFFICIENT = "Insufficient"
DATE_NONNUMERIC = "Nonnumeric data"
DATE_BAD_MONTH = "Invalid month"
DATE_BAD_VALUE = "Datevalue error"


def _parts(col: Column, mask: str) -> tuple[Column, Column, Column]:
    if mask == "YYYYMMDD":
        return F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2)
    if mask == "YYYY-MM-DD":
        return F.substring(col, 1, 4), F.substring(col, 6, 2), F.substring(col, 9, 2)
    raise ValueError(f"unknown mask {mask!r}")


def real_date(col: Column, mask: str = "YYYY-MM-DD") -> Column:
    """The date, or NULL when the text is no calendar date under the mask."""
    shape = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$" if mask == "YYYY-MM-DD" else r"^[0-9]{8}$"
    pattern = "yyyy-MM-dd" if mask == "YYYY-MM-DD" else "yyyyMMdd"
    return F.when(col.rlike(shape), F.try_to_date(col, pattern))


def date_valid(col: Column, mask: str = "YYYY-MM-DD") -> Column:
    """Class of a date text under a mask."""
    year, month, day = _parts(col, mask)
    digits = F.concat(year, month, day)
    text = F.trim(col)
    return (
        F.when(col.isNull() | (F.length(text) < len(mask)), DATE_INSUFFICIENT)
        .when(~digits.rlike("^[0-9]{8}$"), DATE_NONNUMERIC)
        .when(~month.try_cast("int").between(1, 12), DATE_BAD_MONTH)
        .when(real_date(text, mask).isNull(), DATE_BAD_VALUE)
        .otherwise(DATE_VALID)
    )


def date_rules(col: Column) -> Column:
    """First failed calendar rule of a ``YYYYMMDD`` text, NULL when all hold."""
    year, month, day = _parts(col, "YYYYMMDD")
    y, m, d = year.try_cast("int"), month.try_cast("int"), day.try_cast("int")
    leap = F.when(y % 100 == 0, y % 400 == 0).otherwise(y % 4 == 0)
    return (
        F.when(F.trim(year) == "", "year missing")
        .when(~year.rlike("^[0-9]{4}$"), "year not numeric")
        .when(~F.substring(year, 1, 2).isin("19", "20"), "century not valid")
        .when(F.trim(month) == "", "month missing")
        .when(~month.rlike("^[0-9]{2}$") | ~m.between(1, 12), "month not 1-12")
        .when(F.trim(day) == "", "day missing")
        .when(~day.rlike("^[0-9]{2}$") | ~d.between(1, 31), "day not 1-31")
        .when((d == 31) & ~m.isin(1, 3, 5, 7, 8, 10, 12), "31 days not in month")
        .when((d == 30) & (m == 2), "30 days not in month")
        .when((d == 29) & (m == 2) & ~leap, "not a leap year")
    )


def month_end(col: Column) -> Column:
    return F.last_day(col)


def julian(col: Column) -> Column:
    """Two-digit year and day of year as one integer (YYDDD)."""
    return ((F.year(col) % 100) * 1000 + F.dayofyear(col)).cast("int")


def day_complement(col: Column) -> Column:
    """Descending-order day key: 99999 minus YYDDD."""
    return F.lit(99999) - julian(col)


def clock_millis(ts: Column) -> Column:
    """Time of day as HHMMSSmmm."""
    return F.date_format(ts, "HHmmssSSS").cast("int")


def time_complement(ts: Column) -> Column:
    """Descending-order time key: 999999999 minus HHMMSSmmm."""
    return F.lit(999999999) - clock_millis(ts)


def from_complements(day_key: Column, time_key: Column) -> Column:
    """Timestamp of a pair of descending keys; two-digit years are in 2000-2099."""
    yyddd = F.lit(99999) - day_key
    hms = F.lpad((F.lit(999999999) - time_key).cast("string"), 9, "0")
    year = 2000 + F.floor(yyddd / 1000)
    day = F.date_add(F.make_date(year.cast("int"), F.lit(1), F.lit(1)), (yyddd % 1000 - 1).cast("int"))
    return F.to_timestamp(
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), hms), "yyyy-MM-dd HHmmssSSS"
    )


def ts26(ts: Column) -> Column:
    """26-character timestamp text with hundredths of a second."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd-HH.mm.ss.SS"), F.lit("0000"))


def parse_ts26(col: Column) -> Column:
    """Timestamp of a 26-character text (``-`` and ``.`` or blank and ``:`` separators)."""
    text = F.regexp_replace(col, r"^(.{10})[- ](..)[.:](..)[.:](..)", "$1 $2:$3:$4")
    return F.try_to_timestamp(F.rpad(F.trim(text), 26, "0"), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the reformatting and the validity check callable from SQL.

    They are SQL expressions, not Python functions, so Catalyst sees through them.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION ledger_date_compact(d STRING) RETURNS STRING "
        "RETURN concat(substring(d, 1, 4), substring(d, 6, 2), substring(d, 9, 2))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION ledger_date_dashed(d STRING) RETURNS STRING "
        "RETURN concat_ws('-', substring(d, 1, 4), substring(d, 5, 2), substring(d, 7, 2))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION ledger_date_ok(d STRING) RETURNS BOOLEAN "
        "RETURN d RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' AND try_to_date(d, 'yyyy-MM-dd') IS NOT NULL"
    )
