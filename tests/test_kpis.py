"""Indicator tables, percentages and score on hand-made facts."""

import datetime as dt

from conftest import T0, default_customers, make_txns, txn
from pyspark.sql import functions as F

from ledgerlake.config import DEFAULT
from ledgerlake.operators import kpis, score
from ledgerlake.operators.fact import fact_transactions


def _fact(spark, rows):
    return fact_transactions(make_txns(spark, rows), default_customers(spark))


def test_rapid_distribution_window_boundary_and_fanout(spark):
    c = T0
    rows = [
        txn(1, c, txn_type="CREDIT"),
        txn(2, c, txn_type="DEPOSIT"),  # same instant: the join fans out twice
        txn(3, c + dt.timedelta(seconds=10), to_account="A", amount=1),
        txn(4, c + dt.timedelta(seconds=900), to_account="B", amount=2),
        txn(5, c + dt.timedelta(seconds=1800, microseconds=999), to_account="C", amount=4),  # 1800 s: in
        txn(6, c + dt.timedelta(seconds=1801), to_account="D", amount=8),  # 1801 s: out
    ]
    out = kpis.kpi_rapid_distribution(_fact(spark, rows), DEFAULT).collect()
    assert len(out) == 1
    assert out[0]["event_count"] == 1
    assert float(out[0]["total_amount"]) == 2 * (1 + 2 + 4)


def test_rapid_distribution_needs_three_payees(spark):
    rows = [txn(1, T0, txn_type="CREDIT"), txn(2, T0 + dt.timedelta(seconds=5), to_account="A"),
            txn(3, T0 + dt.timedelta(seconds=6), to_account="A"), txn(4, T0 + dt.timedelta(seconds=7), to_account="B")]
    assert kpis.kpi_rapid_distribution(_fact(spark, rows), DEFAULT).count() == 0


def test_impossible_travel_ten_minutes(spark):
    rows = [
        txn(1, T0, location_country="India"),
        txn(2, T0 + dt.timedelta(minutes=10), location_country="Canada"),  # exactly 10: flagged
        txn(3, T0 + dt.timedelta(minutes=20, seconds=1), location_country="India"),  # 10m01s: not
        txn(4, T0 + dt.timedelta(minutes=21), location_country="India", ip_address="10.0.0.2"),  # other IP
    ]
    out = kpis.kpi_impossible_travel(_fact(spark, rows)).collect()
    assert [(r["txn_id"], r["prev_country"], r["time_diff_minutes"]) for r in out] == [("000002", "India", 10.0)]


def test_velocity_more_than_five_in_window(spark):
    rows = [txn(i, T0 + dt.timedelta(seconds=30 * i)) for i in range(6)]  # 6 rows in [12:00, 12:05)
    rows += [txn(10 + i, T0 + dt.timedelta(minutes=5, seconds=30 * i)) for i in range(5)]  # 5 rows
    out = kpis.kpi_transaction_velocity(_fact(spark, rows), DEFAULT).collect()
    assert len(out) == 1 and out[0]["count"] == 6


def test_current_overactivity_channel_limits(spark):
    rows = [txn(1, T0, customer_id="2", account_id="AC2", channel="ATM", amount=200001),
            txn(2, T0 + dt.timedelta(days=1), customer_id="2", account_id="AC2", channel="ONLINE", amount=2000000)]
    out = kpis.kpi_current_overactivity(_fact(spark, rows)).collect()
    assert [r["txn_id"] for r in out] == ["000001"]


def test_savings_abnormal_sums_day_total_per_row(spark):
    rows = [txn(i, T0 + dt.timedelta(minutes=i), channel="ATM", amount=150000) for i in range(2)]
    out = kpis.kpi_savings_abnormal(_fact(spark, rows)).collect()
    assert out[0]["event_count"] == 2 and float(out[0]["total_amount"]) == 600000  # inflated, as in the reference


def test_kyc_pending(spark):
    rows = [txn(1, T0, channel="BRANCH", amount=300000), txn(2, T0, channel="ATM", amount=1)]
    out = kpis.kpi_kyc_pending(_fact(spark, rows)).collect()
    assert [r["txn_id"] for r in out] == ["000002"]


def _score(spark, p):
    df = spark.createDataFrame([tuple(p)], ", ".join(f"p{i} double" for i in range(1, 8)))
    return score.system_risk_score(df).collect()[0]


def test_risk_bands_and_null_score(spark):
    hi = _score(spark, [1.0] * 7)
    assert hi["risk_level"] == "HIGH" and abs(hi["risk_score"] - (0.7 * 0.95 + 0.3)) < 1e-12
    mid = _score(spark, [0.4] * 7)
    assert mid["risk_level"] == "MEDIUM"
    zero = _score(spark, [0.0] * 7)  # sum of p = 0: dynamic weight NULL, score NULL -> LOW
    assert zero["risk_score"] is None and zero["risk_level"] == "LOW"


def test_percentages_no_cross_join_and_empty_fact(spark):
    fact = _fact(spark, [txn(1, T0)]).filter(F.lit(False))
    pct = score.kpi_percentages(fact)
    plan = pct._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    row = pct.collect()[0]
    assert all(row[f"p{i}"] is None for i in range(1, 8))
