"""SCD2 history invariants, change tracking and incremental merge."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import scd2

SCHEMA = "k string, v int, seq timestamp_ntz"


def _changes(spark):
    d = lambda day, h=0: dt.datetime(2024, 1, day, h)
    rows = [("a", 1, d(1)), ("a", 1, d(2)), ("a", 2, d(3)), ("a", 2, d(3)),  # exact duplicate collapses
            ("b", 5, d(2, 5)), ("b", 6, d(2, 9)), ("c", 1, d(9))]
    rows += [("hot", i % 3, d(1 + i % 28, i % 24)) for i in range(300)]
    return spark.createDataFrame(rows, SCHEMA).dropDuplicates(["k", "seq"])


def test_intervals_chain_and_one_open_version(spark):
    h = scd2.rebuild(_changes(spark), ["k"], "seq")
    rows = h.collect()
    assert h.filter(F.col("__END_AT").isNull()).groupBy("k").count().filter("count != 1").count() == 0
    w = Window.partitionBy("k").orderBy("__START_AT")
    chk = h.withColumn("nxt", F.lead("__START_AT").over(w)).filter(~F.col("__END_AT").eqNullSafe(F.col("nxt")))
    assert chk.count() == 0
    assert all(r["__START_AT"] == r["seq"] for r in rows)


def test_track_columns_skips_unchanged_versions(spark):
    h = scd2.rebuild(_changes(spark), ["k"], "seq", track_columns=["v"])
    a = sorted((r["v"], r["__START_AT"].day, r["__END_AT"] and r["__END_AT"].day) for r in h.filter("k = 'a'").collect())
    assert a == [(1, 1, 3), (2, 3, None)]


def test_incremental_merge_equals_rebuild_and_is_idempotent(spark):
    ch = _changes(spark)
    first, second = ch.filter(F.dayofmonth("seq") % 2 == 0), ch.filter(F.dayofmonth("seq") % 2 == 1)
    h1 = scd2.rebuild(first, ["k"], "seq")
    h2 = scd2.merge_increment(h1, second, ["k"], "seq")
    h3 = scd2.merge_increment(h2, second, ["k"], "seq")  # replayed batch
    full = scd2.rebuild(ch, ["k"], "seq")
    assert sorted(h2.collect()) == sorted(full.collect())
    assert sorted(h3.collect()) == sorted(full.collect())


def test_hot_key_split_does_not_change_history(spark):
    ch = _changes(spark)
    base = sorted(scd2.rebuild(ch, ["k"], "seq").collect())
    assert sorted(scd2.rebuild(ch, ["k"], "seq", hot_min_versions=1).collect()) == base  # every key split
    assert sorted(scd2.rebuild(ch, ["k"], "seq", hot_keys=1, hot_min_versions=1).collect()) == base  # "hot" only
    tracked = sorted(scd2.rebuild(ch, ["k"], "seq", ["v"]).collect())
    assert sorted(scd2.rebuild(ch, ["k"], "seq", ["v"], hot_min_versions=1).collect()) == tracked
