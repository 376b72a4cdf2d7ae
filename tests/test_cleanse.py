"""ANSI-safe cleansing, quarantine, dedup and column cleaning."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.columns import clean_columns
from ledgerlake.operators import cleanse


def _bronze(spark, rows):
    cols = ["txn_id", "account_id", "customer_id", "txn_timestamp", "txn_type", "amount", "currency", "from_account",
            "to_account", "channel", "device_id", "ip_address", "location_country", "location_city", "location_lat",
            "location_lon", "merchant_id", "merchant_category", "status"]
    full = [dict(zip(cols, [None] * len(cols)), **r) for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in full], ", ".join(f"{c} string" for c in cols))


def _row(i, amount="10.00", ts="2024-01-05 10:00:00.000001", **kw):
    row = dict(txn_id=str(i), account_id="AC1", customer_id="1", txn_timestamp=ts, txn_type="transfer",
               amount=amount, currency="USD", from_account="AC1", to_account="B", channel="upi", status="success",
               merchant_id="M1")
    row.update(kw)
    return row


def test_bad_values_do_not_fail_and_are_dropped(spark):
    b = _bronze(spark, [_row(1, amount="n/a"), _row(2, ts="2024-13-45 99:99:99.000000"), _row(3, amount="12.345"),
                        _row(4, amount="0.50"), _row(5, amount="-1")])
    s = {r["txn_id"]: r for r in cleanse.silver_transactions(b, "2024-02-01 00:00:00").collect()}
    assert set(s) == {"3", "4"}
    assert str(s["3"]["amount"]) == "12.35"  # decimal(18,2) rounds half-up
    assert str(s["4"]["normalised_amount"]) == "47.00"  # USD x 94
    assert (s["3"]["txn_type"], s["3"]["channel"], s["3"]["location_country"]) == ("TRANSFER", "UPI", "UNKNOWN")
    q = {r["txn_id"] for r in cleanse.quarantine_transactions(b).collect()}
    assert q == {"5"}  # "0.50" is positive as a decimal, unlike an integer comparison


def test_latest_copy_wins_even_for_a_hot_key(spark):
    rows = [_row(7, ts=f"2024-01-{d:02d} 10:00:00.000000") for d in range(1, 29)] * 20
    b = _bronze(spark, rows)
    out = cleanse.silver_transactions(b, "2024-02-01 00:00:00").collect()
    assert len(out) == 1 and str(out[0]["txn_timestamp"]) == "2024-01-28 10:00:00"


def test_validation_and_account_flags(spark):
    b = _bronze(spark, [_row(1), _row(2, from_account="AC9"), dict(_row(3), txn_type="credit", from_account=None)])
    s = {r["txn_id"]: r for r in cleanse.silver_transactions(b, "2024-02-01 00:00:00").collect()}
    assert (s["1"]["account_match_flag"], s["1"]["txn_validation_flag"]) == ("SAME_ACCOUNT", "VALID")
    assert s["2"]["account_match_flag"] == "SUSPICIOUS"
    assert (s["3"]["account_match_flag"], s["3"]["txn_validation_flag"]) == ("Not_Applicable", "VALID")


def test_clean_columns_renames_and_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`_ingest ts` int, `a-b` int")
    assert clean_columns(df).columns == ["ingest_ts", "a_b"]
    with pytest.raises(ValueError):
        clean_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    with pytest.raises(ValueError):
        clean_columns(spark.createDataFrame([(1,)], "`__` int"))


def test_split_by_rules_first_failure(spark):
    df = spark.createDataFrame([(1, None), (-1, "x"), (5, "y")], "a int, b string")
    out = cleanse.split_by_rules(df, [("a_positive", F.col("a") > 0), ("b_present", F.col("b").isNotNull())])
    assert sorted((r["a"], r["failed_rule"]) for r in out.collect()) == [(-1, "a_positive"), (1, "b_present"), (5, None)]


def test_wall_clock_in_a_zone_with_daylight_saving(spark):
    from ledgerlake.functions.parsing import to_wall_timestamp

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-02-30 02:30:00",), ("x",), (None,), ("2024-03-10 02:30:00.000001",)], "s string")
        got = [str(r[0]) for r in rows.select(to_wall_timestamp(F.col("s"), "yyyy-MM-dd HH:mm:ss")).collect()]
        assert got == ["2024-03-10 02:30:00", "None", "None", "None", "None"]
        fine = rows.select(to_wall_timestamp(F.col("s"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).where("t is not null").collect()
        assert [str(r[0]) for r in fine] == ["2024-03-10 02:30:00.000001"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_clock_default(spark):
    import datetime as dt

    from ledgerlake.operators import cleanse
    from ledgerlake.sources import binding

    bronze = binding.bronze_transactions(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    stamps = [r[0] for r in cleanse.silver_transactions(bronze).select("ingest_timestamp").distinct().collect()]
    assert len(stamps) == 1 and abs(stamps[0] - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=10)


def test_pivot_has_every_channel(spark):
    from ledgerlake.operators import reports

    fact = spark.createDataFrame([("2024-01-01", "ATM", 10), ("2024-01-01", "NEFT", 99)], "txn_date string, channel string, amount int")
    got = reports.report_daily_pivot(reports.report_daily(fact)).collect()
    assert [(int(r["ATM"]), int(r["NEFT"])) for r in got] == [(10, 99)]


def test_audit_names_the_first_failed_rule(spark):
    rows = [{"txn_id": "1", "account_id": "a", "customer_id": "c", "amount": "5", "txn_timestamp": "2024-01-01 00:00:00.000000"},
            {"txn_id": "2", "account_id": "a", "amount": "5"}, {"txn_id": "3", "account_id": "a", "customer_id": "c", "amount": "-1"},
            {"txn_id": "4", "account_id": "a", "customer_id": "c", "amount": "5", "txn_timestamp": "?"}]
    got = cleanse.audit(_bronze(spark, rows), cleanse.TRANSACTIONS)
    named = {r["txn_id"]: r["failed_rule"] for r in got.collect()}
    assert named == {"1": None, "2": "customer_id missing", "3": "amount not positive", "4": "txn_timestamp unreadable"}
