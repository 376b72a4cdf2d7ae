"""What a merge of a batch moves: every row once."""

import datetime as dt

from ledgerlake.config import scratch_path
from ledgerlake.operators import scd2
from ledgerlake.streaming import latest, scd2_stream

from conftest import T0

SCHEMA = "k string, v int, at timestamp_ntz"


def _batch(spark, rows):
    return spark.createDataFrame([(k, v, T0 + dt.timedelta(days=d)) for k, v, d in rows], SCHEMA)


def _plans(monkeypatch, module):
    plans, write = [], module.write_buckets

    def written(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *args, **options)

    monkeypatch.setattr(module, "write_buckets", written)
    return plans


def test_open_versions_are_shuffled_once(spark, monkeypatch):
    target, plans = scratch_path(spark, "t-open"), _plans(monkeypatch, scd2_stream)
    batches = [[("a", 1, 0), ("b", 1, 0), ("c", 1, 0)], [("a", 2, 1), ("d", 1, 0)], [("b", 0, -1), ("a", 3, 2)]]
    for n, rows in enumerate(batches):
        scd2_stream.apply_changes(_batch(spark, rows), target, ["k"], "at", n, buckets=2)
    assert "LeftAnti" not in plans[1] and "LeftSemi" not in plans[1]
    want = scd2.rebuild(_batch(spark, [r for b in batches for r in b]), ["k"], "at")
    got = scd2_stream.read_history(spark, target).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_open_rows_without_a_key_stay(spark):
    target = scratch_path(spark, "t-nokey")
    for n, rows in enumerate([[(None, 1, 0), ("a", 1, 0)], [(None, 2, 1), ("a", 2, 1)]]):
        scd2_stream.apply_changes(_batch(spark, rows), target, ["k"], "at", n, buckets=1)
    got = scd2_stream.read_history(spark, target).collect()
    assert sorted((str(r["k"]), r["v"], r["__END_AT"] is None) for r in got) == [("None", 1, True), ("None", 2, True), ("a", 1, False), ("a", 2, True)]


def test_a_merge_of_newest_copies_is_computed_once(spark, monkeypatch):
    target, plans = scratch_path(spark, "t-latest"), _plans(monkeypatch, latest)
    merge = latest.latest_writer(target, ["k"], ["at"], buckets=2)
    for n, rows in enumerate([[("a", 1, 0), ("b", 1, 0)], [("a", 2, 1), ("b", 0, -1), ("c", 1, 0)]]):
        merge(_batch(spark, rows), n)
    assert "Exchange hashpartitioning(k" not in plans[1]  # the merge that its bucket ids were taken from
    assert sorted((r["k"], r["v"]) for r in latest.read_latest(spark, target).collect()) == [("a", 2), ("b", 1), ("c", 1)]
