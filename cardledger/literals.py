"""Literal tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def values_sql(rows: list[tuple], columns: list[str], casts: list[str]) -> str:
    """A literal table, typed by cast.  VALUES gives Spark one local relation of known size."""
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    names = [f"c{i}" for i in range(len(columns))]
    picked = ", ".join(f"CAST({n} AS {t}) AS {c}" for n, c, t in zip(names, columns, casts))
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT {picked} FROM (VALUES {body}) AS v({', '.join(names)})"


def literal_table(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """Literal rows as a local relation, which Spark broadcasts by its known size."""
    return spark.sql(values_sql(rows, list(columns), list(columns.values())))
