"""Newest copies kept from a stream equal the batch aggregate over all rows, in any order of arrival."""

import itertools

import pytest

from ledgerlake.config import scratch_path
from ledgerlake.operators.cleanse import latest_per_key
from ledgerlake.sources import tables
from ledgerlake.streaming import latest

SCHEMA = "k string, at int, v string"


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def held(spark, target):
    return sorted(map(str, latest.read_latest(spark, target).select("k", "at", "v").collect()))


def test_any_order_of_arrival(spark):
    parts = [
        rows(spark, ("a", 1, "old"), ("b", 5, "x"), (None, 1, "null key"), ("c", None, "no time")),
        rows(spark, ("a", 9, "new"), ("b", 5, "y"), ("c", -3, "timed")),
        rows(spark, ("a", 4, "mid"), ("b", 2, "z"), (None, 0, "older"), ("d", 1, None), ("d", 1, None)),
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    want = sorted(map(str, latest_per_key(every, ["k"], ["at"]).collect()))
    assert len(want) == 5 and any("new" in w for w in want) and any("timed" in w for w in want)
    for order in ((0, 1, 2), (1, 2, 0), (2, 1, 0)):
        target = scratch_path(spark, "t-latest")
        apply = latest.latest_writer(target, ["k"], ["at"], buckets=4)
        for n, p in enumerate(order):
            apply(parts[p], n)
        assert held(spark, target) == want, order


def test_old_copies_and_replays_write_nothing(spark):
    target = scratch_path(spark, "t-latest")
    first = rows(spark, *[(f"k{i}", 5, "x") for i in range(40)])
    assert latest.merge_latest(first, target, ["k"], ["at"], 0, 4) == [0, 1, 2, 3]
    version = tables.published(spark, target)
    assert latest.merge_latest(first.replace(5, 4), target, ["k"], ["at"], 1, 4) == []
    assert latest.merge_latest(first, target, ["k"], ["at"], 2, 4) == []  # equal rows: those held stay
    assert latest.merge_latest(first.limit(0), target, ["k"], ["at"], 3, 4) == []
    assert tables.published(spark, target) == version
    assert len(latest.merge_latest(rows(spark, ("k7", 6, "x"), ("k8", 1, "x")), target, ["k"], ["at"], 4, 4)) == 1
    latest.latest_writer(target, ["k"], ["at"])(rows(spark, ("k7", 99, "replayed")), 4)
    assert "replayed" not in str(held(spark, target)) and len(held(spark, target)) == 40


def test_columns_come_and_go(spark):
    target = scratch_path(spark, "t-latest")
    with pytest.raises(tables.TableNotFound):
        latest.read_latest(spark, target)
    latest.merge_latest(rows(spark, ("a", 1, "x")), target, ["k"], ["at"], 0)
    changed = spark.createDataFrame([("a", 2, 7), ("b", 1, 8)], "k string, at int, extra int")
    latest.merge_latest(changed, target, ["k"], ["at"], 1)
    assert latest.read_latest(spark, target).columns == ["k", "at", "v"]
    assert held(spark, target) == ["Row(k='a', at=2, v=None)", "Row(k='b', at=1, v=None)"]


def test_empty_first_batch(spark):
    target = scratch_path(spark, "t-latest")
    assert latest.merge_latest(rows(spark, ("a", 1, "x")).limit(0), target, ["k"], ["at"], 0) == []
    assert tables.published(spark, target) is None


def test_buckets_that_doubled(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1)
    target = scratch_path(spark, "t-latest")
    for n, (lo, hi) in enumerate(itertools.pairwise([0, 30, 20, 60, 10])):
        latest.merge_latest(rows(spark, *[(f"k{i}", n, "x") for i in range(min(lo, hi), max(lo, hi))]), target, ["k"], ["at"], n, 2)
    assert tables.published(spark, target)[1]["modulus"] > 8
    want = {f"k{i}": max(n for n, (lo, hi) in enumerate([(0, 30), (20, 30), (20, 60), (10, 60)]) if lo <= i < hi) for i in range(60)}
    assert {r["k"]: r["at"] for r in latest.read_latest(spark, target).collect()} == want
