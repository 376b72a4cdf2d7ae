"""Boundary fixtures for the fact's rules (hour 4/5, 400000, 90/91 days,
604800/604801 s, first-transaction sentinel, null defaults)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import T0, default_customers, make_txns, txn

from ledgerlake.operators.fact import fact_transactions


def _fact(spark, rows, customers=None):
    f = fact_transactions(make_txns(spark, rows), customers or default_customers(spark))
    return {r["txn_id"]: r for r in f.collect()}


def test_night_and_high_amount_boundaries(spark):
    rows = [
        txn(1, dt.datetime(2024, 1, 10, 4, 59, 59), amount=400000),
        txn(2, dt.datetime(2024, 1, 10, 5, 0, 0), amount="399999.99"),
        txn(3, dt.datetime(2024, 1, 10, 0, 0, 0)),
    ]
    f = _fact(spark, rows)
    assert (f["000001"]["night_indicator"], f["000001"]["high_amount_flag"]) == (1, 1)
    assert (f["000002"]["night_indicator"], f["000002"]["high_amount_flag"]) == (0, 0)
    assert f["000003"]["night_indicator"] == 1


def test_gap_sentinel_and_whole_seconds(spark):
    rows = [txn(1, T0), txn(2, T0 + dt.timedelta(seconds=90, microseconds=900000)),
            txn(3, T0 + dt.timedelta(days=3))]
    f = _fact(spark, rows)
    assert f["000001"]["txn_gap_minutes"] == 99999.0
    assert f["000002"]["txn_gap_minutes"] == 1.5  # whole seconds: 90 / 60
    assert f["000003"]["txn_gap_minutes"] == (3 * 86400 - 90) / 60  # previous day carried across days


def test_new_beneficiary_90_vs_91_days(spark):
    rows = [
        txn(1, T0, to_account="X"),
        txn(2, T0 + dt.timedelta(days=90), to_account="X"),  # 90 days: not new
        txn(3, T0, to_account="Y", txn_type="DEBIT"),  # CASH_OR_MERCHANT override
        txn(4, T0 + dt.timedelta(days=1), to_account="Z"),
        txn(5, T0 + dt.timedelta(days=92), to_account="Z"),  # 91 days after: new again
        txn(6, T0 + dt.timedelta(days=92, hours=1), to_account="Z"),  # same day: not new
        txn(7, T0 + dt.timedelta(days=2), to_account="W", txn_type="CREDIT"),  # not a TRANSFER
    ]
    f = _fact(spark, rows)
    assert [f[f"00000{i}"]["new_beneficiary_flag"] for i in range(1, 8)] == [1, 0, 0, 1, 1, 0, 0]
    assert f["000003"]["to_account"] == "CASH_OR_MERCHANT"
    assert f["000007"]["from_account"] == "EXTERNAL_SOURCE"


def test_rolling_window_inclusive_both_ends(spark):
    rows = [
        txn(1, T0, amount=1),
        txn(2, T0 + dt.timedelta(seconds=1), amount=10),
        txn(3, T0 + dt.timedelta(seconds=604800), amount=100),  # 604800 s after #1: #1 included
        txn(4, T0 + dt.timedelta(seconds=604801, microseconds=500), amount=1000),  # #1 out, #2 in
        txn(5, T0 + dt.timedelta(seconds=604801, microseconds=900), amount=10000),  # same second peer
    ]
    f = _fact(spark, rows)
    assert float(f["000003"]["rolling_7day_amount"]) == 111
    assert float(f["000004"]["rolling_7day_amount"]) == 11110
    assert float(f["000005"]["rolling_7day_amount"]) == 11110


def test_daily_features_and_placeholders_count(spark):
    rows = [txn(1, T0, to_account="X"), txn(2, T0, to_account="X"), txn(3, T0, txn_type="WITHDRAWAL"),
            txn(4, T0 + dt.timedelta(days=1))]
    f = _fact(spark, rows)
    r = f["000001"]
    assert (r["daily_txn_count"], r["daily_unique_beneficiaries"]) == (3, 2)  # X and CASH_OR_MERCHANT
    assert float(r["daily_total_amount"]) == 300
    assert f["000004"]["daily_txn_count"] == 1


def test_null_defaults_and_geo_flag(spark):
    rows = [
        txn(1, T0, customer_id="9", account_id="AC9", txn_type=None, channel=None, status=None, ip_address=None,
            location_country=None, to_account=None, from_account=None),
    ]
    f = _fact(spark, rows)
    r = f["000001"]
    assert (r["txn_type"], r["channel"], r["status"]) == ("UNKNOWN", "UNKNOWN", "UNKNOWN")
    assert (r["kyc_status"], r["account_type"]) == ("MINIMAL", "UNKNOWN")
    assert (r["ip_address"], r["from_account"], r["to_account"]) == ("UNKNOWN_IP", "UNKNOWN", "UNKNOWN")
    assert (r["home_country"], r["location_country"], r["geo_mismatch_flag"]) == ("UNKNOWN", "UNKNOWN", 0)


def test_ip_history_falls_back_to_current(spark):
    rows = [
        txn(1, T0, location_country="India", location_city="Pune"),
        txn(2, T0 + dt.timedelta(minutes=5), location_country="Canada", location_city="Toronto"),
        txn(3, T0 + dt.timedelta(days=2), location_country="Canada", location_city="Ottawa", ip_address="10.9.9.9"),
        txn(4, T0 + dt.timedelta(days=5), location_country="India", location_city="Delhi"),
    ]
    f = _fact(spark, rows)
    assert (f["000001"]["previous_ip_city"], f["000001"]["previous_ip_country"]) == ("Pune", "India")
    assert (f["000002"]["previous_ip_city"], f["000002"]["previous_ip_country"]) == ("Pune", "India")
    assert f["000003"]["previous_ip_city"] == "Ottawa"  # first on that IP
    assert f["000004"]["previous_ip_city"] == "Toronto"  # carried across days on the same IP


def test_segment_size_and_hot_split_do_not_change_results(spark):
    import pytest

    rows = [txn(i, T0 + dt.timedelta(minutes=37 * i), to_account=f"P{i % 3}", ip_address=f"10.0.0.{i % 2}",
                location_country=["India", "Canada"][i % 2], amount=1000 * (i + 1)) for i in range(40)]
    rows += [txn(100 + i, T0 + dt.timedelta(minutes=53 * i), customer_id="2", account_id="AC2",
                 to_account=f"P{i % 2}") for i in range(15)]
    txns, custs = make_txns(spark, rows), default_customers(spark)
    base = sorted(fact_transactions(txns, custs).collect())  # nobody is hot: one segment per customer
    variants = [dict(segment_seconds=s, hot_min_rows=0) for s in (1, 60, 3600, 86400)]
    variants.append(dict(segment_seconds=60, hot_min_rows=0, hot_keys=1))  # only the largest customer split
    for kw in variants:
        assert sorted(fact_transactions(txns, custs, **kw).collect()) == base, kw
    with pytest.raises(ValueError):
        fact_transactions(txns, custs, segment_seconds=7)


def test_hot_customers_is_bounded_top_k(spark):
    from ledgerlake.operators.fact import add_time_columns, hot_customers

    rows = [txn(i, T0 + dt.timedelta(minutes=i), customer_id=str(i % 4 if i < 60 else 9)) for i in range(100)]
    df = add_time_columns(make_txns(spark, rows), 60, hot_keys=2, hot_min_rows=1)
    hot = {r["customer_id"] for r in hot_customers(make_txns(spark, rows), hot_keys=2, hot_min_rows=1).collect()}
    assert len(hot) == 2 and "9" in hot  # customer 9 has 40 rows, the others 15
    segs = {r["customer_id"]: r["n"] for r in df.groupBy("customer_id").agg(F.countDistinct("__seg").alias("n")).collect()}
    assert segs["9"] > 1 and all(segs[c] == 1 for c in segs if c not in hot)
