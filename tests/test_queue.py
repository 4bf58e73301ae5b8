"""Runs bounded by messages or idleness go on where the last one ended."""

import datetime as dt
from decimal import Decimal as D

import pyarrow.dataset as pads
from pyspark.sql import functions as F

from cardledger.streaming import queue as Q


def messages(spark, ids):
    rows = [(i, D(i) / 4, dt.datetime(2024, 1, 1, 0, i % 60, 0, i), f"m{i}", None) for i in ids]
    return spark.createDataFrame(rows, "id bigint, amt decimal(12,2), ts timestamp, text string, note string")


def test_runs_by_messages_and_idleness(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "MESSAGES_PER_TASK", 7)
    box, out, ckpt = (str(tmp_path / n) for n in ("box", "out", "ckpt"))
    Q.append_messages(messages(spark, range(50)), box, ["id"])
    assert Q.waiting(spark, box) == 50

    def go(most, wait=0.0):
        def each(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        return Q.run_messages(spark, box, lambda df: df.where("id % 10 <> 3"), each, ckpt, most, wait)

    def seen():
        return sorted(r.id for r in spark.read.parquet(out).collect())

    assert go(20) == 20 and seen() == [i for i in range(20) if i % 10 != 3]
    assert go(7) == 7 and max(seen()) == 26
    assert go(100, wait=0.1) == 23 and len(seen()) == 45  # ends as nothing waits
    assert go(5) == 0
    Q.append_messages(messages(spark, range(50, 60)), box, ["id"], at=50)
    assert go(500) == 10 and seen() == [i for i in range(60) if i % 10 != 3]
    want = messages(spark, range(60)).where("id % 10 <> 3")
    got = spark.read.parquet(out).select(*want.columns)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_a_run_that_broke_off_is_repeated(spark, tmp_path):
    box, out, ckpt = (str(tmp_path / n) for n in ("box", "out", "ckpt"))
    Q.append_messages(messages(spark, range(30)), box, ["id"])
    tries = []

    def each(batch, batch_id):
        tries.append(batch_id)
        if len(tries) == 2:
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def go():
        return Q.run_messages(spark, box, lambda df: df, each, ckpt, 10)

    assert go() == 10
    try:
        go()
    except Exception as error:
        assert "lost" in str(error)
    while go():
        pass
    found = spark.read.parquet(out)
    assert found.count() == 30 and found.agg(F.countDistinct("id")).first()[0] == 30


def test_a_task_reads_small_row_groups(spark, tmp_path, monkeypatch):
    """The files' row groups and the decoded batches are small, however many messages a file holds."""
    monkeypatch.setattr(Q, "GROUP_BYTES", 50_000)
    monkeypatch.setattr(Q, "MESSAGES_PER_BATCH", 300)
    box = str(tmp_path / "box")
    Q.append_messages(messages(spark, range(20_000)), box, ["id"])
    groups = [g.num_rows for f in pads.dataset(box, format="parquet").get_fragments() for g in f.row_groups]
    assert sum(groups) == 20_000 and max(groups) < 5_000
    reader = Q._Reader(spark.read.parquet(box).schema, {"path": box, "until": "20000", "per_task": "7000"})
    batches = [b for part in reader.partitions({"next": 500}, {"next": 17_000}) for b in reader.read(part)]
    assert max(b.num_rows for b in batches) <= 300
    assert sorted(i for b in batches for i in b.column("id").to_pylist()) == list(range(500, 17_000))
