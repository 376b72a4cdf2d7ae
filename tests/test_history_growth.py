"""Histories that grow: what a batch writes, buckets that double, buckets that hold much of the data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.config import scratch_path
from ledgerlake.operators import scd2
from ledgerlake.sources import tables
from ledgerlake.streaming import scd2_stream

KEYS = ["k"]


def batch(spark, keys, hour, v=0):
    return spark.createDataFrame([(f"{k}", v, dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)) for k in keys], "k string, v int, seq timestamp_ntz")


def applied(spark, target, batches, buckets=8):
    apply = scd2_stream.scd2_batch_writer(target, KEYS, "seq", buckets)
    for n, rows in enumerate(batches):
        apply(rows, n)
    every = batches[0]
    for rows in batches[1:]:
        every = every.unionByName(rows)
    want = scd2.rebuild(every, KEYS, "seq")
    got = scd2_stream.read_history(spark, target)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    current = scd2_stream.read_current(spark, target)
    assert sorted(map(str, current.select(*want.columns).collect())) == sorted(map(str, scd2.current(want).collect()))
    return tables.published(spark, target)[1]


def test_closed_versions_are_not_written_again(spark):
    target = scratch_path(spark, "t-growth")
    batches = [batch(spark, range(60), h, h) for h in range(5)]
    content = applied(spark, target, batches)
    assert all(len(e) == 4 for e in content["closed"].values())  # one small write a batch and bucket
    last = content["buckets"]["0"][0].split("/__")[0]
    assert spark.read.parquet(f"{target}/{last}").count() == 120  # 60 open and the 60 they closed, of 300


def test_late_rows_and_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(scd2_stream, "MERGE_WRITES", 3)
    target = scratch_path(spark, "t-growth")
    hours = [1, 9, 5, 12, 5, 3, 20, 21, 22]
    content = applied(spark, target, [batch(spark, range(n % 3, 30), h, n) for n, h in enumerate(hours)])
    assert all(len(e) <= 4 for e in content["closed"].values())


def test_buckets_double_and_old_ones_are_read_in_part(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1)
    target = scratch_path(spark, "t-growth")
    batches = [batch(spark, range(80), 1), batch(spark, range(5), 2, 1), batch(spark, range(40, 44), 3, 2), batch(spark, range(0, 80, 9), 2, 3), batch(spark, range(80), 9, 4)]
    content = applied(spark, target, batches, buckets=2)
    assert content["modulus"] == 2 * 2 ** len(batches)
    some = tables.read_buckets(spark, target, [0, 3], ("buckets",))
    assert {r[0] for r in tables.with_bucket(some, KEYS, content["modulus"]).select(tables.BUCKET).distinct().collect()} <= {0, 3}


def test_bucket_with_much_of_the_data_spans_tasks(spark):
    # Small data would else come from one task, which has nothing to split.
    names = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        target = scratch_path(spark, "t-growth")
        hot = spark.range(60_000).select(F.lit("hot").alias("k"), F.xxhash64("id").cast("string").alias("v"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("seq"))
        scd2_stream.scd2_batch_writer(target, KEYS, "seq", 4)(hot.repartition(16), 0)
        (entry,) = next(iter(tables.published(spark, target)[1]["closed"].values()))
        files = [n for n in tables.Store(spark, f"{target}/{entry[0]}/{tables.BUCKET}={entry[1]}").names("") if n.endswith(".parquet")]
        assert len(files) > 1
        assert scd2_stream.read_history(spark, target).count() == 60_000 and scd2_stream.read_current(spark, target).count() == 1
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)


def test_empty_batch_changes_nothing(spark):
    target = scratch_path(spark, "t-growth")
    content = applied(spark, target, [batch(spark, range(3), 1), batch(spark, range(3), 2).limit(0)])
    assert content["batch"] == 0
    with pytest.raises(tables.TableNotFound):
        scd2_stream.read_current(spark, scratch_path(spark, "t-none"))
