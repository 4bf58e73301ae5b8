"""Row filters and the report periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_date_range(tx: DataFrame, start: dt.date, end: dt.date, column: str = "proc_date") -> DataFrame:
    """Rows whose date lies between ``start`` and ``end``, both included.

    A timestamp column is compared as it is, without a cast, so that the range reaches the scan.
    """
    kind = tx.schema[column].dataType.typeName()
    if kind.startswith("timestamp"):
        after = end + dt.timedelta(days=1)
        first, last = F.lit(start).cast(kind), F.lit(after).cast(kind)
        return tx.where((F.col(column) >= first) & (F.col(column) < last))
    return tx.where(F.col(column).between(F.lit(start), F.lit(end)))


def filter_day(tx: DataFrame, day: dt.date, column: str = "proc_date") -> DataFrame:
    return tx.where(F.col(column) == F.lit(day))


def filter_cards(cards: DataFrame, acct_id: int | None = None, card_num: str | None = None) -> DataFrame:
    """Equality filters that are skipped when not given."""
    if acct_id is not None:
        cards = cards.where(F.col("acct_id") == acct_id)
    if card_num is not None:
        cards = cards.where(F.col("card_num") == card_num)
    return cards


def filter_types_like(
    types: DataFrame, type_cd: str | None = None, pattern: str | None = None
) -> DataFrame:
    if type_cd is not None:
        types = types.where(F.col("type_cd") == type_cd)
    if pattern is not None:
        types = types.where(F.col("type_desc").like(pattern))
    return types


def report_period(
    kind: str, asof: dt.date, start: str | None = None, end: str | None = None
) -> tuple[dt.date, dt.date]:
    """First and last day of a Monthly, Yearly or Custom report."""
    if kind == "Monthly":
        first = asof.replace(day=1)
        after = (first + dt.timedelta(days=32)).replace(day=1)
        return first, after - dt.timedelta(days=1)
    if kind == "Yearly":
        return asof.replace(month=1, day=1), asof.replace(month=12, day=31)
    if kind == "Custom":
        if not start or not end:
            raise ValueError("start and end date are required")
        first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
        return first, last
    raise ValueError(f"unknown report kind {kind!r}")


def expired(details: DataFrame, asof: dt.date, days: int) -> Column:
    """Whether an authorization is at least ``days`` days old.  The time is compared as it is stored,
    so the bound reaches the scan."""
    first_kept = dt.datetime.combine(asof - dt.timedelta(days=days - 1), dt.time())
    kind = details.schema["auth_ts"].dataType
    return F.col("auth_ts") < F.lit(first_kept).cast(kind)


def filter_expired(details: DataFrame, asof: dt.date, days: int = 5) -> DataFrame:
    """Authorizations at least ``days`` days old."""
    return details.where(expired(details, asof, days))


def filter_payable(accounts: DataFrame) -> DataFrame:
    return accounts.where(F.col("curr_bal") > 0)
