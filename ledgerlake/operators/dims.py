"""Gold dimensions from the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUSTOMER_DIM = [
    "customer_id", "account_id", "customer_name", "age", "account_type", "account_balance",
    "kyc_status", "is_active", "home_country", "home_city", "account_opening_date",
]
DEVICE_DIM = [
    "session_id", "customer_id", "device_id", "device_type", "ip_address", "location_country", "location_city",
    "is_new_device", "is_new_location", "login_timestamp", "logout_timestamp", "session_duration_seconds",
]


def dim_customers(silver_customers: DataFrame) -> DataFrame:
    return silver_customers.select(*CUSTOMER_DIM)


def dim_devices(silver_sessions: DataFrame) -> DataFrame:
    """Session/device rows, full-row distinct (an aggregate: map-side dedup)."""
    return silver_sessions.select(*DEVICE_DIM).dropDuplicates()


def dim_merchants(silver_transactions: DataFrame) -> DataFrame:
    """Distinct (merchant_id, merchant_category) pairs; a merchant seen under
    two categories appears twice, as in the reference."""
    return (
        silver_transactions.select("merchant_id", "merchant_category")
        .filter(F.col("merchant_id").isNotNull())
        .dropDuplicates()
    )
