"""The refreshed fact equals a rebuild, and only dates that changed are written."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.config import scratch_path
from ledgerlake.operators.changes import changed_groups
from ledgerlake.operators.fact import fact_transactions
from ledgerlake.plans import build, refresh
from ledgerlake.sources import tables

from conftest import default_customers, make_txns, txn

DAY = dt.datetime(2024, 1, 1, 12)


def made(spark, seed, n=160):
    rnd = random.Random(seed)
    rows = [txn(i, DAY + dt.timedelta(days=rnd.randrange(40), minutes=rnd.randrange(600)), customer_id=rnd.choice("1234"), to_account=rnd.choice(["B1", "B2", "B3", None]),
                ip_address=rnd.choice(["10.0.0.1", "10.0.0.2"]), amount=rnd.randrange(1, 9000), txn_type=rnd.choice(["TRANSFER", "DEPOSIT", "DEBIT"]),
                location_city=rnd.choice(["Mumbai", "Pune"])) for i in range(n)]
    return rows


def refreshed(spark, old, new, old_customers=None, new_customers=None, **options):
    path = scratch_path(spark, "t-refresh")
    customers = default_customers(spark)
    old_customers, new_customers = old_customers or customers, new_customers or customers
    refresh.build_fact(path, make_txns(spark, old), old_customers)
    before = tables.published(spark, path)[1]["parts"]
    dates = refresh.refresh_fact(spark, path, make_txns(spark, old), make_txns(spark, new), old_customers, new_customers, **options)
    after = tables.published(spark, path)[1]["parts"]
    got = sorted(map(tuple, tables.read_table(spark, path).collect()), key=str)
    want = fact_transactions(make_txns(spark, new), new_customers)
    assert tables.read_table(spark, path).columns == want.columns
    want, stale = want.collect(), fact_transactions(make_txns(spark, old), old_customers).collect()
    assert got == sorted(map(tuple, want), key=str)
    written = {p for p in after if after[p] != before.get(p)} | (set(before) - set(after))
    assert {f"txn_date={d}" for d in dates} == written
    a, b = (collections.defaultdict(list), collections.defaultdict(list))
    for rows, by in ((stale, a), (want, b)):
        for r in rows:
            by[r["txn_date"]].append(str(tuple(r)))
    assert dates == sorted(d for d in a.keys() | b.keys() if sorted(a[d]) != sorted(b[d]))
    return dates


@pytest.mark.parametrize("seed", [1, 2])
def test_added_changed_and_removed_rows(spark, seed):
    old = made(spark, seed)
    new = [r for r in old if r["txn_id"] not in ("000003", "000050")]
    new = [dict(r, amount=r["amount"] + 1) if r["txn_id"] == "000010" else r for r in new] + [txn(900 + k, DAY + dt.timedelta(days=20 + k), customer_id="2") for k in range(2)]
    dates = refreshed(spark, old, new, hot_min_rows=0 if seed == 1 else 10**6)
    assert 0 < len(dates) < 40


def test_one_late_row_reaches_seven_days_and_the_next_rows(spark):
    old = [txn(k, DAY + dt.timedelta(days=3 * k), customer_id="1") for k in range(12)] + [txn(100 + k, DAY + dt.timedelta(days=k), customer_id="2") for k in range(30)]
    late = txn(500, DAY + dt.timedelta(days=10), customer_id="1")
    dates = refreshed(spark, old, [*old, late])
    assert dates == [(DAY + dt.timedelta(days=d)).date() for d in (10, 12, 15)]  # its day, the next row, the rolling sums


def test_nothing_changed_writes_nothing(spark):
    old = made(spark, 3, 40)
    assert refreshed(spark, old, old) == []


def test_customer_attributes_reach_all_dates(spark):
    old = made(spark, 4, 60)
    customers = default_customers(spark)
    changed = customers.withColumn("home_country", F.when(F.col("customer_id") == "2", "Norway").otherwise(F.col("home_country")))
    dates = refreshed(spark, old, old, customers, changed)
    assert dates == sorted({r["txn_timestamp"].date() for r in old if r["customer_id"] == "2" and r["account_id"] == "AC2"}) or dates == []


def test_changed_groups_counts_repeated_rows(spark):
    df = lambda *rows: spark.createDataFrame(list(rows), "k string, v int")
    old, new = df(("a", 1), ("a", 1), ("b", 2), ("c", 3), (None, 4)), df(("a", 1), ("b", 2), ("c", 4), ("d", 5), (None, 4))
    assert sorted(r["k"] for r in changed_groups(old, new, ["k"], ["k", "v"]).collect()) == ["a", "c", "d"]


def test_build_refreshes_only_changed_dates(spark):
    landing, out = scratch_path(spark, "t-landing"), scratch_path(spark, "t-out")
    build.land_from_tables(spark, "/root/testdata/sf0.001", landing)
    build.run(spark, landing, out, as_of="2024-02-01 00:00:00")
    path = f"{out}/gold/fact_transactions"
    before = tables.published(spark, path)[1]["parts"]
    header = spark.read.option("header", True).csv(f"{landing}/transactions")
    row = header.where("txn_timestamp like '2024-01-1%' and txn_id is not null and cast(amount as decimal(18,2)) > 0").limit(1)
    row.withColumn("txn_id", F.lit("999999")).write.mode("append").option("header", True).csv(f"{landing}/transactions")
    tables2 = build.run(spark, landing, out, as_of="2024-02-02 00:00:00")
    after = tables.published(spark, path)[1]["parts"]
    touched = [p for p in after if after[p] != before[p]]
    assert 0 < len(touched) < len(after)
    fact, txns = tables.read_table(spark, path), tables.read_table(spark, tables2["silver/transactions"])
    customers = tables.read_table(spark, tables2["silver/customers"])
    want = fact_transactions(txns, customers)
    assert fact.count() == want.count() and fact.exceptAll(want).count() == 0
