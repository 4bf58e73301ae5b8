"""Names, keys, tokens and character-class tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardledger.codes import area_codes


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.rtrim(col), F.lit(""))


def first_token(col: Column) -> Column:
    """Text up to the first blank."""
    return F.split_part(F.coalesce(col, F.lit("")), F.lit(" "), F.lit(1))


def name_line(first: Column, middle: Column, last: Column) -> Column:
    """First tokens of the three names, one blank after each."""
    return F.concat(*[p for c in (first, middle, last) for p in (first_token(c), F.lit(" "))])


def address_line(city: Column, state: Column, country: Column, zip_code: Column) -> Column:
    """First tokens of the last address line, state, country and zip, one blank after each."""
    return F.concat(
        *[p for c in (city, state, country, zip_code) for p in (first_token(c), F.lit(" "))]
    )


def tokens(col: Column, names: list[str], delimiter: str = ",") -> list[Column]:
    """One column per delimited field; missing trailing fields are NULL."""
    parts = F.split(col, f"\\Q{delimiter}\\E", -1)
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]


def alpha_only(col: Column) -> Column:
    """Letters and blanks, at least one letter."""
    return F.coalesce(col.rlike("^[A-Za-z ]*$") & (F.trim(col) != ""), F.lit(False))


def alnum_only(col: Column) -> Column:
    """Letters, digits and blanks, at least one that is not blank."""
    return F.coalesce(col.rlike("^[A-Za-z0-9 ]*$") & (F.trim(col) != ""), F.lit(False))


def num_only(col: Column) -> Column:
    """Digits only, and not all zero."""
    return F.coalesce(col.rlike("^[0-9]+$") & ~col.rlike("^0+$"), F.lit(False))


PHONE = r"^\(([0-9]{3})\)([0-9]{3})-([0-9]{4})$"


def phone_part(col: Column, part: int) -> Column:
    """Area code (1), prefix (2) or line number (3) of ``(aaa)bbb-cccc``; '' when malformed."""
    return F.regexp_extract(F.rtrim(col), PHONE, part)


def us_phone(col: Column, area_known: Column | None = None) -> Column:
    """Blank, or a well-formed number whose three parts are not zero.

    ``area_known`` says whether the area code is assigned; without it the library's list decides.
    """
    known = phone_part(col, 1).isin(area_codes()) if area_known is None else area_known
    good = (
        (phone_part(col, 1) != "")
        & (phone_part(col, 1) != "000")
        & (phone_part(col, 2) != "000")
        & (phone_part(col, 3) != "0000")
        & known
    )
    return F.coalesce(F.trim(col) == "", F.lit(True)) | F.coalesce(good, F.lit(False))


def us_ssn(col: Column) -> Column:
    """Nine digits; part one not 000, 666 or 900-999, parts two and three not zero."""
    return F.coalesce(
        col.rlike("^[0-9]{9}$")
        & ~F.substring(col, 1, 3).isin("000", "666")
        & (F.substring(col, 1, 1) != "9")
        & (F.substring(col, 4, 2) != "00")
        & (F.substring(col, 6, 4) != "0000"),
        F.lit(False),
    )


def fico_range(col: Column) -> Column:
    return F.coalesce(col.between(300, 850), F.lit(False))


def response_letter(resp_code: Column) -> Column:
    """A for approved (00), D for everything else."""
    return F.when(resp_code == "00", "A").otherwise("D")


def fraud_text(flag: Column, report_date: Column) -> Column:
    """``F-<date>`` or ``R-<date>`` when a fraud mark exists, else ``-``."""
    return F.when(
        flag.isin("F", "R"), F.concat(flag, F.lit("-"), F.date_format(report_date, "MM/dd/yy"))
    ).otherwise("-")


def pad_left(col: Column, length: int, fill: str = " ") -> Column:
    """Filled up on the left to ``length``; a longer text stays whole."""
    return F.when(F.length(col) > length, col).otherwise(F.lpad(col, length, fill))


def pad_right(col: Column, length: int, fill: str = " ") -> Column:
    """Filled up on the right to ``length``; a longer text stays whole."""
    return F.when(F.length(col) > length, col).otherwise(F.rpad(col, length, fill))


def pad_key(col: Column, length: int) -> Column:
    """Number as text with leading zeros; a longer one stays whole, so no two keys become one."""
    return pad_left(col.cast("string"), length, "0")


def fits(col: Column, length: int, what: str) -> Column:
    """The text, or an error if it is longer than its field."""
    message = F.concat(F.lit(f"{what} does not fit {length} characters: "), col)
    return F.when(F.length(col) > length, F.raise_error(message).cast("string")).otherwise(col)
