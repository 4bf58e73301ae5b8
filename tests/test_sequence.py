"""Numbering and neighbours in buckets against plain windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cardledger.operators import sequence as S

BIG = {"rows_per_bucket": 300}


def frame(spark, n=3000):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.4 else f"g{rnd.randint(1, 30)}", i, rnd.choice([None, "A", "D"]))
            for i in range(n)]
    return spark.createDataFrame(rows, "g string, i bigint, v string").repartition(6)


def test_run_sequence(spark):
    got = S.run_sequence(frame(spark), ["g", "i"], **BIG).orderBy("g", "i").collect()
    assert [r.seq_no for r in got] == list(range(1, 3001))


def test_stored_input_gives_the_same(spark):
    got = S.run_sequence(frame(spark), ["g", "i"], start=11, store=True, **BIG).orderBy("g", "i").collect()
    assert [r.seq_no for r in got] == list(range(11, 3011))


def same(left, right):
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def test_group_sequence(spark):
    df = frame(spark)
    w = Window.partitionBy("g").orderBy("i")
    same(S.group_sequence(df, ["g"], ["i"], "n", **BIG).select("g", "i", "n"),
         df.select("g", "i", F.row_number().over(w).cast("bigint").alias("n")))


def test_last_before(spark):
    df = frame(spark)
    w = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    same(S.last_before(df, ["g"], ["i"], F.col("v"), "l", **BIG).select("g", "i", "l"),
         df.select("g", "i", F.last("v", ignorenulls=True).over(w).alias("l")))


def test_next_in_group(spark):
    df = frame(spark)
    w = Window.partitionBy("g").orderBy("i")
    same(S.next_in_group(df, ["g"], ["i"], ["i"], "x", **BIG).select("g", "i", F.col("x.i").alias("x")),
         df.select("g", "i", F.lead("i").over(w).alias("x")))


def test_pages_of_twenty(spark):
    df = spark.range(45).select((F.col("id") + 1).alias("s"))
    got = dict(df.groupBy(S.page_number(F.col("s"), 20).alias("p")).count().collect())
    assert got == {1: 20, 2: 20, 3: 5}


def test_column_names_of_the_caller_do_not_clash(spark):
    df = frame(spark).select("g", "i", F.lit(1).alias("_place"), F.lit(2).alias("_bucket"), F.lit(3).alias("_n"))
    got = S.run_sequence(df, ["g", "i"], **BIG)
    assert got.columns == [*df.columns, "seq_no"]
    assert [r.seq_no for r in got.orderBy("g", "i").collect()] == list(range(1, 3001))
