"""End-to-end build: CSV feeds -> bronze -> silver/quarantine -> SCD2 history
-> dimensions, fact -> indicators, percentages, risk score, reports.

Every layer is materialised under one root (Parquet), and every layer reads
the previous one from storage, so each step is an independent Spark job
that can be re-run after a failure without recomputing upstream layers.

    python -m ledgerlake.plans.build --landing DIR --out DIR [--as-of TS]

``--landing`` holds ``transactions/``, ``customers/``, ``device_sessions/``
CSV folders. ``--from-tables SF_DIR`` lands the driver's tables there first.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, Thresholds, get_session, scratch_path, tune_session
from ..operators import cleanse, dims, kpis, reports, score
from ..operators.fact import hot_customers
from ..sources import binding, feeds
from ..sources.tables import (
    BUCKET_BYTES, Store, TableNotFound, content_of, folders, last_batch, notes_of, published, read_buckets, read_table, read_test_table,
    write_table,
)
from ..streaming import ingest, scd2_stream
from . import refresh

FEEDS = {
    "transactions": (feeds.TRANSACTION_FIELDS, True),
    "customers": (feeds.CUSTOMER_FIELDS, False),
    "device_sessions": (feeds.SESSION_FIELDS, False),
}


def land_from_tables(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Write the three CSV feeds derived from the driver's tables."""
    events = read_test_table(spark, sf_dir, "events")
    customer = read_test_table(spark, sf_dir, "customer")
    nation = read_test_table(spark, sf_dir, "nation")
    feeds.land_csv(binding.bronze_transactions(events), f"{landing}/transactions")
    feeds.land_csv(binding.bronze_customers(customer, nation), f"{landing}/customers")
    feeds.land_csv(binding.bronze_sessions(events), f"{landing}/device_sessions")


def _history(spark: SparkSession, path: str, silver: DataFrame, keys: list[str], buckets: int = 8) -> None:
    """Apply a silver snapshot to the SCD2 table at ``path`` (created with ``buckets`` if
    absent), as the streams do: only open versions and newly closed ones are written."""
    try:
        read_table(spark, path)
    except TableNotFound:  # any other error, e.g. of the storage, must not look like a first run
        scd2_stream.apply_changes(silver, path, keys, "ingest_timestamp", 0, buckets)
        return
    scd2_stream.apply_changes(silver, path, keys, "ingest_timestamp", last_batch(spark, path) + 1, buckets)


def _buckets_for(spark: SparkSession, source: str) -> int:
    """A power of two of buckets that hold about ``BUCKET_BYTES`` of the table ``source``, at least 8."""
    size = sum(Store(spark, source).size(folder) for folder in folders(published(spark, source)[1]))
    return max(8, 1 << (size // BUCKET_BYTES).bit_length())


def _fact(spark: SparkSession, tables: dict[str, str], path, t: Thresholds):
    """The fact of the current versions: only dates that changed are written, if the stored
    fact says which versions of the histories it was built from and these are still kept."""
    sources = {name: tables[f"silver/{name}_history"] for name in ("transactions", "customers")}
    txns, customers = (scd2_stream.read_current(spark, p) for p in sources.values())
    # The few customers whose rows are split by time, computed once (<= HOT_KEYS rows).
    write_table(hot_customers(txns), path("gold/_hot_customers"))
    hot, target = read_table(spark, tables["gold/_hot_customers"]), path("gold/fact_transactions")
    notes = {name: published(spark, p)[0] for name, p in sources.items()}
    built_from = notes_of(spark, target)
    before = [content_of(spark, p, built_from.get(name, 0)) for name, p in sources.items()]
    if all(before):
        old_txns, old_customers = (read_buckets(spark, p, parts=("buckets",), content=c) for p, c in zip(sources.values(), before))
        refresh.refresh_fact(spark, target, old_txns, txns, old_customers, customers, t, notes, hot=hot)
    else:
        refresh.build_fact(target, txns, customers, t, notes, hot=hot)
    return hot, target


def run(spark: SparkSession, landing: str, out: str, as_of: str | None = None, t: Thresholds = DEFAULT,
        checkpoint_root: str | None = None) -> dict[str, str]:
    tune_session(spark)
    ckpt = checkpoint_root or f"{out}/_checkpoints"
    tables: dict[str, str] = {}

    def path(name: str) -> str:
        tables[name] = f"{out}/{name}"
        return tables[name]

    # bronze: exactly-once file ingest, each file by its own header
    bronze = {}
    for feed, (fields, rescue) in FEEDS.items():
        ingest.ingest_files(spark, f"{landing}/{feed}", fields, f"{out}/bronze/{feed}", f"{ckpt}/bronze_files_{feed}", rescue)
        tables[f"bronze/{feed}"] = f"{out}/bronze/{feed}/data"
        bronze[feed] = read_table(spark, f"{out}/bronze/{feed}")
    bt, bc, bs = bronze["transactions"], bronze["customers"], bronze["device_sessions"]

    # silver + quarantine
    write_table(cleanse.quarantine_transactions(bt), path("silver/transactions_quarantine"))
    write_table(cleanse.silver_transactions(bt, as_of, t), path("silver/transactions"))
    write_table(cleanse.quarantine_customers(bc), path("silver/customers_quarantine"))
    write_table(cleanse.silver_customers(bc, as_of, t), path("silver/customers"))
    write_table(cleanse.quarantine_sessions(bs), path("silver/device_sessions_quarantine"))
    write_table(cleanse.silver_sessions(bs, as_of), path("silver/device_sessions"))
    st = read_table(spark, tables["silver/transactions"])
    sc = read_table(spark, tables["silver/customers"])
    ss = read_table(spark, tables["silver/device_sessions"])

    # history
    for name, silver, keys in (("transactions", st, ["txn_id"]), ("customers", sc, ["customer_id", "account_id"]), ("device_sessions", ss, ["session_id"])):
        _history(spark, path(f"silver/{name}_history"), silver, keys, _buckets_for(spark, tables[f"silver/{name}"]))

    # gold
    write_table(dims.dim_customers(sc), path("gold/dim_customers"))
    write_table(dims.dim_devices(ss), path("gold/dim_devices"))
    write_table(dims.dim_merchants(st), path("gold/dim_merchants"))
    hot, fact_path = _fact(spark, tables, path, t)
    fact = read_table(spark, fact_path)

    indicator_tables = {
        "gold/kpi_new_beneficiary_high_amt": kpis.kpi_new_beneficiary_high_amt(fact),
        "gold/kpi_rapid_distribution": kpis.kpi_rapid_distribution(fact, t),
        "gold/kpi_savings_abnormal": kpis.kpi_savings_abnormal(fact, t),
        "gold/kpi_current_overactivity": kpis.kpi_current_overactivity(fact, t),
        "gold/kpi_night_velocity": kpis.kpi_night_velocity(fact),
        "gold/kpi_impossible_travel": kpis.kpi_impossible_travel(fact, t, hot=hot),
        "gold/kpi_kyc_pending": kpis.kpi_kyc_pending(fact, t),
    }
    for name, df in indicator_tables.items():
        write_table(df, path(name))
    write_table(kpis.kpi_transaction_velocity(fact, t), path("gold/kpi_transaction_velocity"))

    counts = score.kpi_counts_from_tables(fact, [read_table(spark, tables[n]) for n in indicator_tables])
    write_table(score.kpi_percentages_from_counts(counts), path("gold/kpi_percentages"))
    pct = read_table(spark, tables["gold/kpi_percentages"])
    write_table(score.system_risk_score(pct, t), path("gold/system_risk_score"))

    write_table(reports.report_daily(fact), path("gold/report_daily"))
    write_table(reports.report_monthly(fact), path("gold/report_monthly"))
    daily = read_table(spark, tables["gold/report_daily"])
    write_table(reports.report_daily_pivot(daily), path("gold/report_daily_pivot"))
    return tables


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--landing")
    ap.add_argument("--out")
    ap.add_argument("--as-of")
    ap.add_argument("--from-tables", help="land CSV feeds derived from this driver table folder first")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = get_session(args.master)
    landing = args.landing or scratch_path(spark, "landing")
    out = args.out or scratch_path(spark, "tables")
    if args.from_tables:
        land_from_tables(spark, args.from_tables, landing)
    for name, p in run(spark, landing, out, args.as_of).items():
        print(f"{name}\t{p}")


if __name__ == "__main__":
    main()
