"""Keyset pages: first rows from a key on, last rows before a key.

Spark runs ``orderBy`` + ``limit`` as a top-k: every task keeps only ``size`` rows, nothing is
sorted as a whole, and the key filter reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def page_forward(df: DataFrame, key: str, start: object = None, size: int = 10) -> DataFrame:
    """The first ``size`` rows with key >= ``start``; ``has_next`` tells whether more follow."""
    rows = df if start is None else df.where(F.col(key) >= F.lit(start))
    ahead = rows.orderBy(key).limit(size + 1)
    # The window sees at most size + 1 rows.
    more = ahead.withColumn("has_next", F.count("*").over(Window.partitionBy()) > size)
    return more.orderBy(key).limit(size)


def page_backward(df: DataFrame, key: str, start: object, size: int = 10) -> DataFrame:
    """The last ``size`` rows with key < ``start``, ascending."""
    return df.where(F.col(key) < F.lit(start)).orderBy(F.desc(key)).limit(size).orderBy(key)
