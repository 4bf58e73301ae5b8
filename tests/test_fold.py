"""The ordered fold: brute force, hot keys, both fallbacks."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardledger.operators import headroom

SCHEMA = "k bigint, i bigint, gate bigint, weight bigint, start bigint, eligible boolean, note string"


def brute(rows):
    room, out = {}, {}
    for k, i, gate, weight, start, eligible, _ in rows:
        r = room.setdefault(k, start)
        ok = eligible and gate <= r
        if ok:
            room[k] = r - weight
        out[(k, i)] = ok
    return out


def make(n, seed, signed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 7 if rnd.random() < 0.4 else rnd.randint(1, 40)
        amount = rnd.choice([1, -1, 1, 1]) * int(10 ** rnd.uniform(0, 5))
        amount = 0 if rnd.random() < 0.02 else amount
        start = {9: -5, 11: 0}.get(key, 200_000)
        rows.append((key, i, amount, amount if signed else abs(amount), start, rnd.random() < 0.9, f"n{i}"))
    return rows


def run(spark, rows, partitions=8, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    out = headroom.fold_in_order(df, "k", ["i"], **kwargs)
    assert out.columns == [*df.columns, "accepted"]
    got = out.collect()
    assert all(r.note == f"n{r.i}" for r in got)
    return {(r.k, r.i): r.accepted for r in got}


def test_ordinary_keys(spark):
    rows = make(4000, 1, signed=False)
    assert run(spark, rows) == brute(rows)


def test_partition_count_does_not_matter(spark):
    rows = make(1500, 2, signed=True)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert run(spark, rows, partitions=1) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_hot_keys_in_chunks(spark):
    rows = make(3000, 3, signed=False)
    assert run(spark, rows, hot_rows=500, chunk_rows=128) == brute(rows)


@pytest.mark.parametrize("fan", [2, 32])
def test_hot_keys_of_both_signs(spark, monkeypatch, fan):
    monkeypatch.setattr(headroom, "FAN", fan)
    rows = make(2000, 4, signed=True)
    assert run(spark, rows, hot_rows=500, chunk_rows=64) == brute(rows)


def test_skew_one_key_owns_a_third(spark):
    rows = [(1 if i % 3 == 0 else i, i, 10 + i % 50, 10 + i % 50, 9_000, True, f"n{i}") for i in range(6000)]
    assert run(spark, rows, hot_rows=1000, chunk_rows=256) == brute(rows)


def test_credits_and_limits_met_exactly(spark):
    """A third of the rows in one account that stays at its limit: every headroom from 0 to a few cents."""
    rnd = random.Random(8)
    rows = []
    for i in range(3000):
        amount = rnd.choice([1, 2, 3, 5, 7, 11, 200, -1, -4, 0])
        rows.append((1 if i % 3 == 0 else i, i, amount + (i % 50 == 0), amount, 37, i % 11 > 0, f"n{i}"))
    assert run(spark, rows, hot_rows=200, chunk_rows=16) == brute(rows)


def plain_step(rows, room):
    for gate, weight in rows:
        room -= weight if gate <= room else 0
    return room


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(-6, 30), st.integers(-9, 12)), max_size=12),
    st.lists(st.tuples(st.integers(-6, 30), st.integers(-9, 12)), max_size=12),
)
def test_functions_of_rows(one, two):
    low, top = -40, 60
    as_arrays = lambda rows: [np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1)]
    first, second = headroom.Step.of_rows(*as_arrays(one), low, top), headroom.Step.of_rows(*as_arrays(two), low - 200, top + 200)
    both = first.then(second, top)
    for room in range(low, top + 1):
        assert first(room) == plain_step(one, room)
        assert both(room) == plain_step(one + two, room)
    assert (np.diff(both.at) > 0).all() and (np.diff(both.drop) != 0).all()


def test_size_of_a_function_does_not_grow_with_the_rows():
    """With weights that are never negative the headroom only falls, whatever the number of rows."""
    rng = np.random.default_rng(2)
    amounts = rng.integers(100, 20_000, 20_000)
    start = 1_000_000
    step, sizes = None, []
    for at in range(0, len(amounts), 500):
        own = headroom.Step.of_rows(amounts[at : at + 500], amounts[at : at + 500], 0, start)
        step = own if step is None else step.then(own, start)
        sizes.append(len(step.at))
    assert sizes[-1] <= 2 * max(sizes[:10]) and step(start) == plain_step(zip(amounts, amounts), start)
