"""A change rewrites the buckets that its keys fall into, once, and leaves the others."""

import os

import pytest

from cardledger.operators.changes import update_or_insert
from cardledger.sources import snapshots
from cardledger.sources.buckets import BucketTable


def add(old, new):
    joined = old.join(new.withColumnRenamed("v", "d"), "k", "full")
    return joined.selectExpr("k", "coalesce(v, 0) + coalesce(d, 0) AS v")


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k bigint, v bigint")


def folders(root):
    return {
        (b, c) for b in os.listdir(root) if b.startswith("bucket=") for c in os.listdir(f"{root}/{b}")
    }


def state(spark, table, at=None):
    return {r.k: r.v for r in table.read(spark, at).collect()}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("k",), 16)
    all_buckets = table.change(rows(spark, [(i, i) for i in range(300)]), add, 1)
    assert len(all_buckets) == 16
    before = folders(table.root)
    touched = table.change(rows(spark, [(5, 100), (7, 1), (1000, 3)]), add, 2)
    assert 1 <= len(touched) <= 3
    assert folders(table.root) - before == {(f"bucket={b}", "change=2") for b in touched}
    want = {i: i for i in range(300)} | {5: 105, 7: 8, 1000: 3}
    assert state(spark, table) == want and state(spark, table, 1) == {i: i for i in range(300)}
    # a null key is a key; a third change drops what the last two do not need
    table.change(rows(spark, [(None, 4), (5, 1)]), lambda o, n: update_or_insert(o, n, ["k"]), 3)
    assert state(spark, table) == want | {None: 4, 5: 1}
    table.change(rows(spark, [(5, 2)]), add, 4)
    own = [c for b, c in folders(table.root) if (b, "change=4") in folders(table.root)]
    assert sorted(own) == ["change=3", "change=4"]
    assert table.change(rows(spark, []), add, 5) == [] and state(spark, table)[5] == 3


def test_repeated_and_broken_changes(spark, tmp_path, monkeypatch):
    table = BucketTable(str(tmp_path / "t"), ("k",), 4)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    table.change(rows(spark, [(i, 0) for i in range(50)]), add, 0)
    for _ in range(2):  # sums are not added twice
        table.change(rows(spark, [(3, 5)]), add, 1)
    assert state(spark, table)[3] == 5

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("cardledger.sources.buckets.publish", lost)
        with pytest.raises(RuntimeError):
            table.change(rows(spark, [(4, 9)]), add, 2)
    assert state(spark, table)[4] == 0 and snapshots.current_version(spark, table.root) == 1
    # what it left does not come up with the next change, whatever that touches
    table.change(rows(spark, [(3, 1)]), add, 2)
    assert state(spark, table) == {i: 0 for i in range(50)} | {3: 6}
    with pytest.raises(ValueError):
        table.change(rows(spark, [(3, 1)]), add, 1)
