"""Literal reference rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cardledger.fixtures import TRAN_CATEGORIES, TRAN_TYPES
from cardledger.literals import literal_table


def type_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, TRAN_TYPES, {"type_cd": "STRING", "type_desc": "STRING"})


def category_seed(spark: SparkSession) -> DataFrame:
    columns = {"type_cd": "STRING", "cat_cd": "INT", "cat_desc": "STRING"}
    return literal_table(spark, TRAN_CATEGORIES, columns)


def union_literals(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """UNION ALL of single-row tables."""
    return reduce(DataFrame.union, [literal_table(spark, [r], columns) for r in rows])
