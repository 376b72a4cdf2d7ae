"""Tables and histories survive failures at every step of a write."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.config import scratch_path
from ledgerlake.operators import scd2
from ledgerlake.plans import build
from ledgerlake.sources import tables
from ledgerlake.streaming import scd2_stream

SCHEMA = "k string, v int, seq timestamp_ntz"
H = lambda h: dt.datetime(2024, 1, 1, h)


def _rows(spark, *rows):
    return spark.createDataFrame([(k, v, H(h)) for k, v, h in rows], SCHEMA)


def _failing(df):
    return df.withColumn("v", F.when(F.col("v") == 99, F.raise_error(F.lit("task lost"))).otherwise(F.col("v")).cast("int"))


def test_failed_task_leaves_the_old_version(spark):
    path = scratch_path(spark, "t-table")
    tables.write_table(_rows(spark, ("a", 1, 1)), path)
    with pytest.raises(Exception):
        tables.write_table(_failing(_rows(spark, ("a", 99, 1), ("b", 2, 2))), path)
    assert [r["v"] for r in tables.read_table(spark, path).collect()] == [1]


def test_failure_between_write_and_switch(spark, monkeypatch):
    path = scratch_path(spark, "t-table")
    tables.write_table(_rows(spark, ("a", 1, 1)), path)

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "publish", lost)
        with pytest.raises(RuntimeError):
            tables.write_table(_rows(spark, ("a", 2, 1)), path)
    assert [r["v"] for r in tables.read_table(spark, path).collect()] == [1]
    for v in range(2, 6):  # a version may read the one it replaces; old folders go
        tables.write_table(tables.read_table(spark, path).withColumn("v", F.lit(v)), path)
    assert [r["v"] for r in tables.read_table(spark, path).collect()] == [5]
    assert len(tables.Store(spark, path).names("published")) == tables.KEEP


def test_two_writers_cannot_both_win(spark):
    path = scratch_path(spark, "t-table")
    tables.write_table(_rows(spark, ("a", 1, 1)), path)
    tables.publish(spark, path, {"data": "data/x"}, 1)
    with pytest.raises(tables.ConcurrentWrite):
        tables.publish(spark, path, {"data": "data/y"}, 1)


def test_storage_error_is_no_first_run(spark, monkeypatch):
    path = scratch_path(spark, "t-history")
    first, second = _rows(spark, ("a", 1, 1), ("b", 1, 1)), _rows(spark, ("a", 2, 3))
    rename = lambda df: df.withColumnRenamed("seq", "ingest_timestamp")
    build._history(spark, path, rename(first), ["k"])

    def timeout(*args):
        raise OSError("storage timeout")

    with monkeypatch.context() as m:
        m.setattr(build, "read_table", timeout)
        with pytest.raises(OSError):
            build._history(spark, path, rename(second), ["k"])
    build._history(spark, path, rename(second), ["k"])
    want = scd2.rebuild(rename(first.unionByName(second)), ["k"], "ingest_timestamp")
    assert sorted(tables.read_table(spark, path).collect()) == sorted(want.collect())


def test_moved_date_leaves_no_stale_rows(spark):
    path = scratch_path(spark, "t-fact")
    fact = lambda *rows: spark.createDataFrame(list(rows), "txn_id string, txn_date string")
    tables.write_table(fact(("t1", "2024-01-01"), ("t2", "2024-01-02")), path, ("txn_date",))
    tables.write_table(fact(("t1", "2024-01-02"), ("t2", "2024-01-02")), path, ("txn_date",))
    assert sorted(r["txn_id"] for r in tables.read_table(spark, path).collect()) == ["t1", "t2"]


def test_streamed_history_survives_failures(spark, monkeypatch):
    target = scratch_path(spark, "t-scd2")
    batches = [_rows(spark, ("a", 1, 1), ("b", 1, 1)), _rows(spark, ("a", 3, 5), ("c", 1, 2)), _rows(spark, ("a", 2, 3))]
    apply = scd2_stream.scd2_batch_writer(target, ["k"], "seq", buckets=4)
    apply(batches[0], 0)
    with pytest.raises(Exception):  # a task fails in the write
        apply(_failing(batches[1].withColumn("v", F.lit(99))), 1)
    with monkeypatch.context() as m:  # the driver is lost between write and switch
        m.setattr(tables, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            apply(batches[1], 1)
    with monkeypatch.context() as m:  # the storage fails on read
        m.setattr(scd2_stream, "read_buckets", lambda *a: (_ for _ in ()).throw(OSError("timeout")))
        with pytest.raises(OSError):
            apply(batches[1], 1)
    apply(batches[1], 1)
    apply(batches[1], 1)  # replayed after its publication
    apply(batches[2], 2)
    want = scd2.rebuild(batches[0].unionByName(batches[1]).unionByName(batches[2]), ["k"], "seq")
    assert sorted(scd2_stream.read_history(spark, target).collect()) == sorted(want.collect())


def test_only_touched_buckets_are_written(spark):
    target = scratch_path(spark, "t-buckets")
    apply = scd2_stream.scd2_batch_writer(target, ["k"], "seq", buckets=64)
    apply(spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(H(1)).cast("timestamp_ntz").alias("seq")), 0)
    before = tables.published(spark, target)[1]["buckets"]
    apply(_rows(spark, ("7", 2, 2)), 1)
    after = tables.published(spark, target)[1]["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1


def test_late_row_restores_a_hidden_version(spark):
    first = _rows(spark, ("a", 1, 1), ("a", 1, 3), ("a", 2, 5))
    late = _rows(spark, ("a", 5, 2))
    history = scd2.rebuild(first, ["k"], "seq")
    merged = scd2.tracked(scd2.merge_increment(history, late, ["k"], "seq"), ["k"], "seq", ["v"])
    assert sorted((r["v"], r["seq"].hour) for r in merged.collect()) == [(1, 1), (1, 3), (2, 5), (5, 2)]
    assert [(r["v"], r["seq"].hour) for r in sorted(scd2.tracked(history, ["k"], "seq", ["v"]).collect(), key=lambda r: r["seq"])] == [(1, 1), (2, 5)]
