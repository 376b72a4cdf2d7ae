"""Incremental refresh of the date-partitioned fact.

Every feature of a fact row follows from rows of the same customer: the gap
from the row before, the new-beneficiary flag and the previous location from
the last row to the payee or on the address, the day's totals from the day, the
rolling sum from seven days back. So a change of some transactions can
change facts of their customers only, and none of a date before the customer's
first changed one; a change of a customer's attributes can change all of that
customer's facts. The refresh

1. finds changed customers and their first changed date, by signed digests per
   customer and day (:func:`changed_groups`; no transaction row is shuffled),
2. computes the facts of these customers anew,
3. compares them with the stored ones per date: the dates that differ are
   those that something reached (the day itself, the next row, the seven days after,
   the next payment to a payee),
4. writes these dates, with the other customers' rows as they were, and publishes them
   with the untouched partitions as one version.

The result equals a rebuild. Stored partitions before the first changed date
are not read. Transactions have a customer and a timestamp, as silver ensures.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds, scratch_path
from ..operators.changes import changed_groups
from ..operators.fact import CUSTOMER_COLUMNS, FACT_COLUMNS, fact_transactions
from ..sources.tables import Store, read_table, replace_parts

BY = "txn_date"
EVER = "0001-01-01"  # before every date
#: What the fact reads of a transaction.
TXN_COLUMNS = ["txn_id", "customer_id", "account_id", "device_id", "txn_timestamp", "txn_type", "amount", "channel", "status",
               "from_account", "to_account", "ip_address", "location_country", "location_city"]


def affected_customers(old_txns: DataFrame, new_txns: DataFrame, old_customers: DataFrame, new_customers: DataFrame) -> DataFrame:
    """``(customer_id, first_date)``: customers whose facts can differ, and from which date on."""
    dated = lambda df: df.select(*TXN_COLUMNS, F.to_date("txn_timestamp").alias("first_date"))
    by_day = changed_groups(dated(old_txns), dated(new_txns), ["customer_id", "first_date"], TXN_COLUMNS)
    whole = changed_groups(old_customers, new_customers, ["customer_id"], CUSTOMER_COLUMNS).withColumn("first_date", F.lit(EVER).cast("date"))
    return by_day.unionByName(whole).groupBy("customer_id").agg(F.min("first_date").alias("first_date"))


def refresh_fact(spark: SparkSession, path: str, old_txns: DataFrame, new_txns: DataFrame, old_customers: DataFrame, new_customers: DataFrame,
                 t: Thresholds = DEFAULT, notes: dict | None = None, **fact_options) -> list[dt.date]:
    """Bring the fact at ``path``, built from the old state, to the new one; returns the
    dates that were written. The states are current transactions and customers."""
    scratch = scratch_path(spark, "fact-refresh")
    stored = lambda df, name: (df.write.parquet(f"{scratch}/{name}"), spark.read.schema(df.schema).parquet(f"{scratch}/{name}"))[1]
    affected = stored(affected_customers(old_txns, new_txns, old_customers, new_customers), "customers")
    first = affected.agg(F.min("first_date")).first()[0]
    dates: list[dt.date] = []
    rows = spark.createDataFrame([], read_table(spark, path).select(*FACT_COLUMNS).schema)
    if first is not None:
        from_date = lambda df: df.join(affected, "customer_id").where(F.col(BY) >= F.col("first_date")).select(*FACT_COLUMNS)
        fresh = fact_transactions(new_txns.join(affected, "customer_id", "left_semi"), new_customers.join(affected, "customer_id", "left_semi"), t, **fact_options)
        fresh = stored(from_date(fresh), "fact")
        before = read_table(spark, path).where(F.col(BY) >= F.lit(first.isoformat()).cast("date")).select(*FACT_COLUMNS)  # a partition filter
        dates = sorted(r[0] for r in changed_groups(from_date(before), fresh, [BY], FACT_COLUMNS).collect())  # one row a date
        touched = F.col(BY).isin(dates) if dates else F.lit(False)
        as_before = before.where(touched).join(affected, "customer_id", "left").where(F.col("first_date").isNull() | (F.col(BY) < F.col("first_date")))
        rows = as_before.select(*FACT_COLUMNS).unionByName(fresh.where(touched))
    replace_parts(rows, path, BY, dates, notes=notes)
    Store(spark, scratch).delete("")
    return dates


def build_fact(path: str, txns: DataFrame, customers: DataFrame, t: Thresholds = DEFAULT, notes: dict | None = None, **fact_options) -> None:
    """The whole fact as a new version that :func:`refresh_fact` can go on from."""
    replace_parts(fact_transactions(txns, customers, t, **fact_options), path, BY, None, notes=notes)

