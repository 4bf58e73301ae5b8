"""Fixed-width record files: typed scans with quarantine, and unloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardledger.functions import decode
from cardledger.functions.dates import parse_ts26, real_date, ts26
from cardledger.functions.text import blank_to_null, fits
from cardledger.schemas import Field, Layout


def _typed(raw: Column, field: Field) -> Column:
    if field.kind == "integer":
        return F.trim(raw).try_cast("bigint")
    if field.kind == "zoned":
        return decode.decode_zoned(raw, field.scale, field.length)
    if field.kind == "date":
        return real_date(F.trim(raw))
    if field.kind == "timestamp":
        return parse_ts26(raw)
    return blank_to_null(raw)


def parse_lines(lines: DataFrame, layout: Layout, column: str = "value") -> DataFrame:
    """Text lines to typed columns.

    Blank fields become NULL.  ``bad_fields`` lists the fields that hold text which is not of
    their type, so a bad record is kept aside instead of failing the scan.
    """
    line = F.regexp_replace(F.col(column), "\r$", "")
    raw = {f.name: F.substring(line, f.start, f.length) for f in layout.fields}
    typed = {f.name: _typed(raw[f.name], f) for f in layout.fields}
    bad = [
        F.when((F.trim(raw[f.name]) != "") & typed[f.name].isNull(), F.lit(f.name))
        for f in layout.fields
        if f.kind != "text"
    ]
    flags = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return lines.select(
        *[typed[f.name].alias(f.name) for f in layout.fields], flags.alias("bad_fields")
    )


def scan_fixed_width(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """Scan a text file of fixed-width lines."""
    return parse_lines(spark.read.text(path), layout)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the marker, and the rows with bad fields."""
    good = df.where(F.size("bad_fields") == 0).drop("bad_fields")
    return good, df.where(F.size("bad_fields") > 0)


def _printed(field: Field) -> Column:
    col = F.col(f"`{field.name}`")
    if field.kind == "zoned":
        return decode.encode_zoned(F.coalesce(col, F.lit(0)), field.length, field.scale)
    if field.kind in ("integer", "digits"):
        text = fits(F.coalesce(col, F.lit(0)).cast("string"), field.length, field.name)
        return F.lpad(text, field.length, "0")
    if field.kind == "timestamp":
        return F.rpad(F.coalesce(ts26(col), F.lit("")), field.length, " ")
    text = fits(F.coalesce(col.cast("string"), F.lit("")), field.length, field.name)
    return F.rpad(text, field.length, " ")


def render_lines(df: DataFrame, layout: Layout, filler: str = " ") -> DataFrame:
    """Typed columns to lines of the layout's length; gaps and the rest are ``filler``.  A value
    longer than its field is an error."""
    parts: list[Column] = []
    at = 1
    for field in layout.fields:
        if field.start > at:
            parts.append(F.lit(filler * (field.start - at)))
        parts.append(_printed(field))
        at = field.start + field.length
    return df.select(F.rpad(F.concat(*parts), layout.length, filler).alias("line"))


def reftable_unload(df: DataFrame, layout: Layout, keys: list[str]) -> DataFrame:
    """A reference table as fixed lines in key order, the unused rest filled with zeros."""
    return render_lines(df.orderBy(*keys), layout, filler="0")


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("overwrite").text(path)
