import datetime as dt
import decimal
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.config import get_session

    s = get_session("local[4]", cpus=8, app="ledgerlake-tests")
    yield s


TXN_SCHEMA = (
    "txn_id string, account_id string, customer_id string, txn_timestamp timestamp_ntz, txn_type string, "
    "amount decimal(18,2), currency string, from_account string, to_account string, channel string, "
    "device_id string, ip_address string, location_country string, location_city string, merchant_id string, "
    "merchant_category string, status string"
)
CUST_SCHEMA = (
    "customer_id string, account_id string, account_type string, account_balance double, kyc_status string, "
    "home_country string, home_city string"
)

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def txn(i, ts, **kw):
    """One canonical transaction row with defaults."""
    row = {
        "txn_id": f"{i:06d}", "account_id": "AC1", "customer_id": "1", "txn_timestamp": ts, "txn_type": "TRANSFER",
        "amount": decimal.Decimal("100.00"), "currency": "INR", "from_account": "AC1", "to_account": "B1",
        "channel": "UPI", "device_id": "D1", "ip_address": "10.0.0.1", "location_country": "India",
        "location_city": "Mumbai", "merchant_id": "M1", "merchant_category": "FUEL", "status": "SUCCESS",
    }
    for k, v in kw.items():
        row[k] = decimal.Decimal(str(v)) if k == "amount" and v is not None else v
    return row


def make_txns(spark, rows):
    cols = [c.split()[0] for c in TXN_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], TXN_SCHEMA)


def make_customers(spark, rows):
    return spark.createDataFrame(rows, CUST_SCHEMA)


def default_customers(spark):
    return make_customers(spark, [("1", "AC1", "SAVINGS", 1000.0, "PENDING", "India", "Mumbai"),
                                  ("2", "AC2", "CURRENT", 50.0, "VERIFIED", "Canada", "Toronto")])
