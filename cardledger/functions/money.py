"""Amounts: exact cents, truncating interest, text numbers and print masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger.functions.text import pad_left


def cents(col: Column) -> Column:
    """Decimal amount with two places to whole cents."""
    return (col * 100).cast("bigint")


def from_cents(col: Column, precision: int = 12) -> Column:
    return (col.cast(T.DecimalType(18, 0)) / 100).cast(T.DecimalType(precision, 2))


def int_div(numerator: Column, denominator: int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", numerator, F.lit(denominator))


def trunc_cents(balance: Column, annual_rate: Column) -> Column:
    """One month of interest on ``balance``, cut (not rounded) to cents.

    Balance cents times rate hundredths over 12 months and 100 percent and 100 hundredths.
    A decimal cast would round, so the division is on integers.
    """
    return from_cents(int_div(cents(balance) * cents(annual_rate), 120000))


def numval(col: Column, precision: int = 18, scale: int = 2) -> Column:
    """Number written with spaces, thousands commas, currency sign and a leading or trailing
    sign (or CR / DB) to decimal; NULL when it is not a number."""
    text = F.upper(F.regexp_replace(col, r"[ ,$]", ""))
    trailing = F.regexp_extract(text, r"^([0-9]*\.?[0-9]+|[0-9]+\.)(\+|-|CR|DB)$", 1)
    negative = text.rlike(r"(-|CR|DB)$")
    moved = F.when(trailing != "", F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), trailing))
    plain = F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), text)
    return F.coalesce(moved, plain).try_cast(T.DecimalType(precision, scale))


def is_number(col: Column) -> Column:
    return numval(col).isNotNull()


def _grouped(col: Column) -> Column:
    """Absolute value with commas and two places; no digit before the point below one."""
    text = F.format_number(F.abs(col), 2)
    return F.when(F.abs(col) < 1, F.substring(text, 2, 3)).otherwise(text)


def edit_amount(col: Column, mask: str) -> Column:
    """Print an amount under one of the masks the reports use.

    An amount with more digits than its mask is printed whole and makes the field wider.
    """
    if mask in ("-ZZZ,ZZZ,ZZZ.ZZ", "+ZZZ,ZZZ,ZZZ.ZZ"):
        plus = "+" if mask[0] == "+" else " "
        sign = F.when(col < 0, F.lit("-")).otherwise(F.lit(plus))
        return F.when(col == 0, F.lit(" " * 15)).otherwise(
            F.concat(sign, pad_left(_grouped(col), 14))
        )
    tail = F.when(col < 0, F.lit("-")).otherwise(F.lit(" "))
    plain = F.abs(col).cast(T.DecimalType(38, 2)).cast("string")
    if mask == "9(9).99-":
        return F.concat(pad_left(plain, 12, "0"), tail)
    if mask == "Z(9).99-":
        cut = F.when(F.abs(col) < 1, F.substring(plain, 2, 3)).otherwise(plain)
        return F.concat(pad_left(cut, 12), tail)
    if mask == "+9(10).99":
        sign = F.when(col < 0, F.lit("-")).otherwise(F.lit("+"))
        return F.concat(sign, pad_left(plain, 13, "0"))
    raise ValueError(f"unknown mask {mask!r}")
