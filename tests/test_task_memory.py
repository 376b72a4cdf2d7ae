"""A task's memory is bounded by a small partition, sorted as few times as the orders differ."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.config import scratch_path, tune_session
from ledgerlake.operators import scd2
from ledgerlake.operators.fact import fact_transactions

from conftest import T0, default_customers, make_txns, txn


def _sorts(df, until: str) -> tuple[int, int]:
    """Sorts of the rows themselves: after the last exchange named ``until``, and between it and the input."""
    node, counts, at = df._jdf.queryExecution().executedPlan(), [0, 0], 0
    if node.nodeName() == "AdaptiveSparkPlan":
        node = node.initialPlan()
    while node.children().size():
        counts[at] += node.nodeName() == "Sort"
        at = at or int(node.nodeName() == "Exchange" and until in node.toString().split("\n")[0])
        node = node.children().apply(0)
    return counts[0], counts[1]


def test_fact_rows_are_sorted_once_an_order(spark):
    rows = make_txns(spark, [txn(k, T0 + dt.timedelta(minutes=k)) for k in range(20)])
    path = scratch_path(spark, "t-memory")
    rows.write.parquet(path)
    tune_session(spark)
    # customer's account, time, payee, address
    assert _sorts(fact_transactions(spark.read.parquet(path), default_customers(spark)), "hashpartitioning(customer_id")[0] == 4


def test_merged_partitions_of_the_fact_stay_small(spark):
    tune_session(spark)
    assert spark._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"


def test_a_history_is_sorted_once_after_it_moved(spark):
    path = scratch_path(spark, "t-history")
    spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v"), F.lit(T0).cast("timestamp_ntz").alias("seq")).write.parquet(path)
    after, before = _sorts(scd2.rebuild(spark.read.parquet(path), ["k"], "seq"), "hashpartitioning(k")
    assert (after, before) == (1, 0)


def test_copies_of_a_split_key_collapse(spark):
    """Copies of one version: the greatest by the other columns stays, also for split
    keys, for rows without a sequence value and for rows without a key."""
    at = [None, T0, T0, T0 + dt.timedelta(seconds=1), T0 + dt.timedelta(days=3)]
    rows = [(k, v, s) for k in ("a", "b", None) for v in (1, 3, 2) for s in at]
    changes = spark.createDataFrame(rows, "k string, v int, seq timestamp_ntz").unionByName(
        spark.createDataFrame([("c", 7, T0)], "k string, v int, seq timestamp_ntz"))
    key = lambda r: str(tuple(r))
    base = sorted(scd2.rebuild(changes, ["k"], "seq").collect(), key=key)
    assert len(base) == 13 and all(r["v"] in (3, 7) for r in base)
    for options in ({"hot_min_versions": 1}, {"hot_min_versions": 15, "hot_keys": 1}):
        found = sorted(scd2.rebuild(changes, ["k"], "seq", **options).collect(), key=key)
        assert [r for r in found if r["seq"]] == [r for r in base if r["seq"]]
        assert len(found) == len(base)
