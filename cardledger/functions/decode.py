"""Whole-column decoding and encoding of record number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger.functions.text import fits

# Sign-and-digit characters of the last byte, +0..+9 then -0..-9.
OVERPUNCH = "{ABCDEFGHI}JKLMNOPQR"
OVERPUNCH_DIGITS = "01234567890123456789"


def decode_zoned(col: Column, scale: int = 2, precision: int = 18) -> Column:
    """Signed zoned text to decimal; NULL when the text is not a zoned number."""
    last = F.right(col, F.lit(1))
    digits = F.concat(
        F.substring(col, 1, 30).substr(F.lit(1), F.length(col) - 1),
        F.translate(last, OVERPUNCH, OVERPUNCH_DIGITS),
    )
    sign = F.when(last.rlike("[}J-R]"), F.lit(-1)).otherwise(F.lit(1))
    number = digits.cast(T.DecimalType(precision, 0)) * sign / F.lit(10**scale)
    return F.when(
        col.rlike(r"^[0-9]*[0-9{}A-R]$"), number.cast(T.DecimalType(precision, scale))
    )


def _digits(col: Column, length: int, scale: int) -> Column:
    """Absolute value without its point, with leading zeros; an error if it has more digits."""
    unscaled = (F.abs(col).cast(T.DecimalType(38, scale)) * F.lit(10**scale)).cast(T.DecimalType(38, 0))
    return F.lpad(fits(unscaled.cast("string"), length, "number"), length, "0")


def encode_zoned(col: Column, length: int, scale: int = 2) -> Column:
    """Decimal to signed zoned text of ``length`` characters; an error if it has more digits."""
    digits = _digits(col, length, scale)
    last = F.right(digits, F.lit(1))
    signed = F.when(col < 0, F.translate(last, "0123456789", OVERPUNCH[10:])).otherwise(
        F.translate(last, "0123456789", OVERPUNCH[:10])
    )
    return F.concat(F.substring(digits, 1, length - 1), signed)


def decode_packed(col: Column, scale: int = 2, precision: int = 18) -> Column:
    """Packed decimal bytes (two digits per byte, sign in the last half byte) to decimal."""
    text = F.hex(col)
    digits = text.substr(F.lit(1), F.length(text) - 1)
    sign = F.when(F.right(text, F.lit(1)).isin("B", "D"), F.lit(-1)).otherwise(F.lit(1))
    number = digits.cast(T.DecimalType(precision, 0)) * sign / F.lit(10**scale)
    return F.when(
        text.rlike("^[0-9]*[A-F]$"), number.cast(T.DecimalType(precision, scale))
    )


def encode_packed(col: Column, digits: int, scale: int = 2) -> Column:
    """Decimal to packed bytes holding ``digits`` digits (made odd by a leading zero); an error if
    it has more."""
    text = _digits(col, digits, scale)
    if digits % 2 == 0:
        text = F.concat(F.lit("0"), text)
    return F.unhex(F.concat(text, F.when(col < 0, F.lit("D")).otherwise(F.lit("C"))))


def decode_binary(col: Column, nbytes: int, scale: int = 0, precision: int = 18) -> Column:
    """Big-endian two's complement bytes to bigint, or to decimal when ``scale`` is given."""
    unsigned = F.conv(F.hex(col), 16, 10).cast(T.DecimalType(20, 0))
    top = F.lit(str(2 ** (8 * nbytes - 1))).cast(T.DecimalType(20, 0))
    modulus = F.lit(str(2 ** (8 * nbytes))).cast(T.DecimalType(20, 0))
    value = F.when(unsigned >= top, unsigned - modulus).otherwise(unsigned)
    if scale:
        return (value / F.lit(10**scale)).cast(T.DecimalType(precision, scale))
    return value.cast("bigint")


def encode_binary(col: Column, nbytes: int, scale: int = 0) -> Column:
    """Number to big-endian two's complement bytes; an error if it needs more of them."""
    unscaled = (col * F.lit(10**scale)).cast("bigint")
    if nbytes < 8:
        top = 2 ** (8 * nbytes - 1)
        message = F.concat(F.lit(f"number does not fit {nbytes} bytes: "), unscaled.cast("string"))
        unscaled = F.when(unscaled.between(-top, top - 1), unscaled).when(
            unscaled.isNotNull(), F.raise_error(message).cast("bigint")
        )
    return F.unhex(F.right(F.lpad(F.hex(unscaled), 16, "0"), F.lit(2 * nbytes)))
