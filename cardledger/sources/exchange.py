"""Multi-record exchange file: five kinds of records under a type tag, and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.functions.dates import ts26
from cardledger.functions.text import pad_key
from cardledger.operators.sequence import run_sequence

# Record tags in file order, with the table and its key.
RECORDS = [
    ("C", "customer", "cust_id"), ("A", "account", "acct_id"), ("X", "xref", "card_num"),
    ("T", "transaction", "tran_id"), ("D", "card", "card_num"),
]
TAGS = {tag: name for tag, name, _ in RECORDS}


def export_union(
    tables: dict[str, DataFrame], run_ts: object, branch: str = "0001", region: str = "NORTH"
) -> DataFrame:
    """All tables as one: tag, time, running number, branch, region and one body per kind.

    The body is a struct column per kind, NULL for the other kinds.  Numbers follow the file
    order of the tags and the key inside a tag.
    """
    parts = []
    for place, (tag, name, key) in enumerate(RECORDS):
        if name not in tables:
            continue
        df = tables[name]
        parts.append(
            df.select(
                F.lit(tag).alias("rec_type"), F.lit(place).alias("tag_no"),
                pad_key(F.col(key), 20).alias("record_key"),
                F.struct(*df.columns).alias(name),
            )
        )
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    numbered = run_sequence(union, ["tag_no", "record_key"], "seq_num")
    bodies = [name for _, name, _ in RECORDS if name in tables]
    return numbered.select(
        "rec_type", ts26(F.lit(run_ts).cast("timestamp")).alias("run_ts"), "seq_num",
        F.lit(branch).alias("branch_id"), F.lit(region).alias("region_code"), *bodies,
    )


def import_split(export: DataFrame) -> dict[str, DataFrame]:
    """The typed tables and ``errors`` (unknown tags)."""
    out = {
        name: export.where(F.col("rec_type") == tag).select(f"{name}.*")
        for tag, name in TAGS.items()
        if name in export.columns
    }
    out["errors"] = import_errors(export)
    return out


def import_errors(export: DataFrame) -> DataFrame:
    """One row per unknown record, with the printed line."""
    unknown = export.where(~F.coalesce(F.col("rec_type").isin(*TAGS), F.lit(False)))
    message = F.lit("Unknown record type encountered")
    return unknown.select(
        "run_ts", "rec_type", "seq_num", message.alias("message"),
        F.concat_ws(
            "|", "run_ts", F.coalesce("rec_type", F.lit(" ")),
            pad_key(F.col("seq_num"), 7), F.rpad(message, 50, " "),
        ).alias("line"),
    )


def import_counts(export: DataFrame) -> DataFrame:
    """Rows per kind; kinds and errors together are all records, so the counts reconcile."""
    known = F.col("rec_type").isin(*TAGS)
    label = F.when(known, F.col("rec_type")).otherwise("?")
    return export.groupBy(label.alias("rec_type")).agg(F.count("*").alias("rows"))


def write_export(export: DataFrame, path: str) -> None:
    """One pass over the union; readers of one kind open only its folder."""
    export.write.mode("overwrite").partitionBy("rec_type").parquet(path)
