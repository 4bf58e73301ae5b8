"""Structured error events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event levels and subsystems.
LEVELS = {"L": "log", "I": "info", "W": "warning", "C": "critical"}
SUBSYSTEMS = {"A": "application", "C": "online", "I": "hierarchical store", "D": "database", "M": "queue", "F": "file"}


def error_log(
    df: DataFrame,
    location: str,
    level: str,
    message: str | Column,
    event_key: str,
    at: Column,
    subsystem: str = "A",
    application: str = "cardledger",
    program: str = "",
    code_1: Column | None = None,
    code_2: Column | None = None,
) -> DataFrame:
    """One event per row of a quarantine table."""
    if level not in LEVELS or subsystem not in SUBSYSTEMS:
        raise ValueError("unknown level or subsystem")
    text = F.lit(message) if isinstance(message, str) else message
    blank = F.lit("")
    return df.select(
        F.date_format(at, "yyMMdd").alias("err_date"), F.date_format(at, "HHmmss").alias("err_time"),
        F.lit(application).alias("application"), F.lit(program).alias("program"),
        F.lit(location).alias("location"), F.lit(level).alias("level"),
        F.lit(subsystem).alias("subsystem"),
        F.coalesce(code_1.cast("string") if code_1 is not None else blank, blank).alias("code_1"),
        F.coalesce(code_2.cast("string") if code_2 is not None else blank, blank).alias("code_2"),
        text.alias("message"), F.col(event_key).cast("string").alias("event_key"),
    )


def append_errors(events: DataFrame, path: str, run_id: str) -> None:
    """Append the events of a run to the log at ``path``.

    A run has a folder of its own, which a repeated run replaces: its events are in the log once.
    """
    events.write.mode("overwrite").parquet(f"{path}/run={run_id}")


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """All events of the log, with the run they come from."""
    return spark.read.parquet(path).withColumn("run", F.col("run").cast("string"))
