"""Registered queries: each maps (spark, sf_dir) -> DataFrame over the whole
driver tables. The same keys exist in :mod:`ledgerlake.oracle`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..config import DEFAULT, TEST_WIDE, scratch_path, tune_session
from ..operators import cleanse, dims, kpis, reports, scd2, score
from ..operators.fact import fact_transactions
from ..sources import binding
from ..sources.tables import read_table, read_test_table, write_table
from . import refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def canonical_fact(spark: SparkSession, sf_dir: str, t=None, **fact_options) -> DataFrame:
    """The fact over the driver's ``events`` and ``customer`` tables."""
    tune_session(spark)
    ev = read_test_table(spark, sf_dir, "events")
    cu = read_test_table(spark, sf_dir, "customer")
    return fact_transactions(binding.transactions(ev), binding.customers(cu), t or DEFAULT, **fact_options)


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once to the shared scratch folder, for queries that read it in several branches."""
    path = scratch_path(df.sparkSession, name)
    write_table(df, path, partition_by)
    return read_table(df.sparkSession, path)


@query("fact_transactions")
def q_fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_fact(spark, sf_dir)


@query("fact_transactions_split")
def q_fact_transactions_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same fact with every customer treated as hot (split by minute): the
    segmented path checked against the same oracle."""
    return canonical_fact(spark, sf_dir, hot_min_rows=0)


@query("report_daily")
def q_report_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_daily(canonical_fact(spark, sf_dir))


@query("report_monthly")
def q_report_monthly(spark, sf_dir):
    return reports.report_monthly(canonical_fact(spark, sf_dir))


@query("report_daily_pivot")
def q_report_daily_pivot(spark, sf_dir):
    return reports.report_daily_pivot(stored(reports.report_daily(canonical_fact(spark, sf_dir)), "daily"))


@query("kpi_new_beneficiary_high_amt")
def q_kpi1(spark, sf_dir):
    return kpis.kpi_new_beneficiary_high_amt(canonical_fact(spark, sf_dir))


@query("kpi_night_velocity")
def q_kpi5(spark, sf_dir):
    return kpis.kpi_night_velocity(canonical_fact(spark, sf_dir))


@query("kpi_rapid_distribution")
def q_kpi2(spark, sf_dir):
    return kpis.kpi_rapid_distribution(canonical_fact(spark, sf_dir), DEFAULT)


@query("kpi_rapid_distribution_1d")
def q_kpi2_wide(spark, sf_dir):
    return kpis.kpi_rapid_distribution(canonical_fact(spark, sf_dir), TEST_WIDE)


@query("kpi_savings_abnormal")
def q_kpi3(spark, sf_dir):
    return kpis.kpi_savings_abnormal(canonical_fact(spark, sf_dir))


@query("kpi_current_overactivity")
def q_kpi4(spark, sf_dir):
    return kpis.kpi_current_overactivity(canonical_fact(spark, sf_dir))


def _flat_velocity(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "customer_id", "count"
    )


@query("kpi_transaction_velocity")
def q_velocity(spark, sf_dir):
    return _flat_velocity(kpis.kpi_transaction_velocity(canonical_fact(spark, sf_dir), DEFAULT))


@query("kpi_transaction_velocity_1d")
def q_velocity_wide(spark, sf_dir):
    return _flat_velocity(kpis.kpi_transaction_velocity(canonical_fact(spark, sf_dir), TEST_WIDE))


@query("kpi_impossible_travel")
def q_kpi6(spark, sf_dir):
    return kpis.kpi_impossible_travel(canonical_fact(spark, sf_dir))


@query("kpi_impossible_travel_split")
def q_kpi6_split(spark, sf_dir):
    """KPI 6 with every customer treated as hot: the split path against the same oracle."""
    return kpis.kpi_impossible_travel(canonical_fact(spark, sf_dir), hot_min_rows=0)


@query("fact_beneficiary_5d")
def q_fact_beneficiary_5d(spark, sf_dir):
    """The fact's new-beneficiary rule with 5 days instead of 90, so that "long ago" occurs in the data."""
    return canonical_fact(spark, sf_dir, DEFAULT.with_(new_beneficiary_days=5)).select(
        "txn_id", "new_beneficiary_flag"
    )


@query("kpi_kyc_pending")
def q_kpi7(spark, sf_dir):
    return kpis.kpi_kyc_pending(canonical_fact(spark, sf_dir))


@query("kpi_percentages")
def q_percentages(spark, sf_dir):
    return score.kpi_percentages(stored(canonical_fact(spark, sf_dir), "score-fact"), DEFAULT)


@query("system_risk_score")
def q_score(spark, sf_dir):
    return score.system_risk_score(q_percentages(spark, sf_dir), DEFAULT)


@query("system_risk_score_1d")
def q_score_wide(spark, sf_dir):
    return score.system_risk_score(score.kpi_percentages(stored(canonical_fact(spark, sf_dir), "score-fact"), TEST_WIDE), TEST_WIDE)


# --- cleansing, dimensions, history ----------------------------------------

AS_OF = "2024-02-01 00:00:00"


def _events(spark, sf_dir):
    return read_test_table(spark, sf_dir, "events")


def _bronze_customers(spark, sf_dir):
    return binding.bronze_customers(read_test_table(spark, sf_dir, "customer"), read_test_table(spark, sf_dir, "nation"))


@query("quarantine_transactions")
def q_quarantine_txn(spark, sf_dir):
    return cleanse.quarantine_transactions(binding.bronze_transactions(_events(spark, sf_dir)))


@query("silver_transactions")
def q_silver_txn(spark, sf_dir):
    return cleanse.silver_transactions(binding.bronze_transactions(_events(spark, sf_dir)), AS_OF)


@query("quarantine_customers")
def q_quarantine_cust(spark, sf_dir):
    return cleanse.quarantine_customers(_bronze_customers(spark, sf_dir))


@query("silver_customers")
def q_silver_cust(spark, sf_dir):
    return cleanse.silver_customers(_bronze_customers(spark, sf_dir), AS_OF)


@query("quarantine_sessions")
def q_quarantine_sess(spark, sf_dir):
    return cleanse.quarantine_sessions(binding.bronze_sessions(_events(spark, sf_dir)))


@query("silver_sessions")
def q_silver_sess(spark, sf_dir):
    return cleanse.silver_sessions(binding.bronze_sessions(_events(spark, sf_dir)), AS_OF)


@query("dim_customers")
def q_dim_customers(spark, sf_dir):
    return dims.dim_customers(q_silver_cust(spark, sf_dir))


@query("dim_devices")
def q_dim_devices(spark, sf_dir):
    return dims.dim_devices(q_silver_sess(spark, sf_dir))


@query("dim_merchants")
def q_dim_merchants(spark, sf_dir):
    return dims.dim_merchants(q_silver_txn(spark, sf_dir))


def _customer_changes(spark, sf_dir):
    return binding.customer_changes(read_test_table(spark, sf_dir, "customer"))


@query("scd2_customers")
def q_scd2_customers(spark, sf_dir):
    return scd2.rebuild(_customer_changes(spark, sf_dir), ["customer_id", "account_id"], "ingest_timestamp")


@query("scd2_customers_tracked")
def q_scd2_customers_tracked(spark, sf_dir):
    return scd2.rebuild(
        _customer_changes(spark, sf_dir), ["customer_id", "account_id"], "ingest_timestamp", ["account_balance"]
    )


@query("scd2_current_customers")
def q_scd2_current(spark, sf_dir):
    return scd2.current(q_scd2_customers(spark, sf_dir))


@query("scd2_transactions")
def q_scd2_transactions(spark, sf_dir):
    """Two ingests of the same feed: every re-ingest is a new version."""
    bronze = binding.bronze_transactions(_events(spark, sf_dir))
    return scd2.rebuild(_two_ingests(cleanse.silver_transactions, bronze), ["txn_id"], "ingest_timestamp")


def _two_ingests(silver, bronze):
    """Two ingests of the same feed: every re-ingest is a new version."""
    return silver(bronze, AS_OF).unionByName(silver(bronze, "2024-02-02 00:00:00"))


@query("scd2_sessions")
def q_scd2_sessions(spark, sf_dir):
    return scd2.rebuild(
        _two_ingests(cleanse.silver_sessions, binding.bronze_sessions(_events(spark, sf_dir))), ["session_id"], "ingest_timestamp"
    )


@query("scd2_late_batch")
def q_scd2_late_batch(spark, sf_dir):
    """The second version of every customer arrives after the third; the
    tracked view of the merged history equals the one of a rebuild."""
    keys = ["customer_id", "account_id"]
    changes = _customer_changes(spark, sf_dir)
    late = F.to_date("ingest_timestamp") == F.lit("2024-01-02").cast("date")
    history = stored(scd2.rebuild(changes.filter(~late), keys, "ingest_timestamp"), "late-history")
    merged = scd2.merge_increment(history, changes.filter(late), keys, "ingest_timestamp")
    return scd2.tracked(merged, keys, "ingest_timestamp", ["account_balance"])


@query("fact_partition_prune")
def q_fact_partition_prune(spark, sf_dir):
    """Fact materialised with ``partitionBy("txn_date")``; a date predicate is
    then a PartitionFilters entry (only that directory is listed and read)."""
    return stored(canonical_fact(spark, sf_dir), "fact-by-date", ("txn_date",)).filter(F.col("txn_date") == F.lit("2024-01-15").cast("date"))


@query("fact_from_history")
def q_fact_from_history(spark, sf_dir):
    """The reference's path: bronze -> silver -> SCD2 history -> current
    versions of transactions and customers -> fact."""
    tune_session(spark)
    txn_hist = stored(scd2.rebuild(q_silver_txn(spark, sf_dir), ["txn_id"], "ingest_timestamp"), "txn-history")
    cust_hist = stored(
        scd2.rebuild(q_silver_cust(spark, sf_dir), ["customer_id", "account_id"], "ingest_timestamp"), "cust-history"
    )
    return fact_transactions(scd2.current(txn_hist), scd2.current(cust_hist), DEFAULT)


@query("fact_incremental")
def q_fact_incremental(spark, sf_dir):
    """The fact built before some deposits and withdrawals arrive and some customers get
    their balance, then refreshed: late rows change their day, the next rows and the rolling sums after them."""
    tune_session(spark)
    txns, customers = binding.transactions(_events(spark, sf_dir)), binding.customers(read_test_table(spark, sf_dir, "customer"))
    late = F.col("txn_type").isin("DEPOSIT", "WITHDRAWAL") & F.col("txn_timestamp").between(F.lit("2024-01-08").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz"))
    first = customers.withColumn("account_balance", F.when(F.col("account_balance") >= -900, F.col("account_balance")))
    path = scratch_path(spark, "fact-incremental")
    refresh.build_fact(path, txns.where(~late), first)
    refresh.refresh_fact(spark, path, txns.where(~late), txns, first, customers)
    return read_table(spark, path)


from . import stream_queries  # noqa: E402,F401  (registers source/stream queries)
