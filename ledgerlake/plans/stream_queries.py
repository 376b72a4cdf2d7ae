"""Registered queries for sources, sinks and streams.

Each lands feeds derived from the driver's tables under the shared
checkpoint folder, runs the stream to completion (``availableNow``) and
returns the resulting table with its deterministic columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TEST_WIDE, scratch_path
from ..operators import cleanse
from ..sources import binding, feeds
from ..sources.tables import append_table, read_table, read_test_table, write_table
from ..streaming import ingest, latest, live, scd2_stream
from ..streaming.table_log import run_table_stream
from .queries import AS_OF, _two_ingests, query


def _land_and_ingest(spark, feed: DataFrame, fields, name: str, rescue: bool = False, csv_options=None) -> DataFrame:
    landing, table, ckpt = (scratch_path(spark, f"{name}-{p}") for p in ("landing", "table", "checkpoint"))
    writer = feed.write.mode("overwrite").option("header", True)
    for k, v in (csv_options or {}).items():
        writer = writer.option(k, v)
    writer.csv(landing)
    ingest.ingest_bronze(spark, landing, fields, table, ckpt, rescue)
    return spark.read.parquet(table)


def _events(spark, sf_dir):
    return read_test_table(spark, sf_dir, "events")


@query("bronze_transactions")
def q_bronze_transactions(spark, sf_dir):
    bronze = _land_and_ingest(
        spark, binding.bronze_transactions(_events(spark, sf_dir)), feeds.TRANSACTION_FIELDS, "bronze-txn", rescue=True
    )
    return bronze.select(*feeds.TRANSACTION_FIELDS, "rescued_data")


@query("bronze_customers")
def q_bronze_customers(spark, sf_dir):
    feed = binding.bronze_customers(read_test_table(spark, sf_dir, "customer"), read_test_table(spark, sf_dir, "nation"))
    return _land_and_ingest(spark, feed, feeds.CUSTOMER_FIELDS, "bronze-cust").select(*feeds.CUSTOMER_FIELDS)


@query("bronze_sessions")
def q_bronze_sessions(spark, sf_dir):
    feed = binding.bronze_sessions(_events(spark, sf_dir))
    return _land_and_ingest(spark, feed, feeds.SESSION_FIELDS, "bronze-sess").select(*feeds.SESSION_FIELDS)


@query("bronze_rescued")
def q_bronze_rescued(spark, sf_dir):
    """Lines with one token too many (a separator inside an unquoted value)
    keep their leading fields and land whole in ``rescued_data``."""
    feed = binding.bronze_transactions(_events(spark, sf_dir))
    eid = F.col("txn_id").cast("bigint")
    feed = feed.withColumn("status", F.when(eid % 97 == 0, F.lit("SUCCESS,EXTRA")).otherwise(F.col("status")))
    bronze = _land_and_ingest(spark, feed, feeds.TRANSACTION_FIELDS, "bronze-rescue", rescue=True,
                              csv_options={"quote": ""})
    # With quoting off the CSV writer puts NUL characters round such a value.
    return bronze.select("txn_id", F.translate("rescued_data", "\x00", "").alias("rescued_data"))


@query("bronze_by_name")
def q_bronze_by_name(spark, sf_dir):
    """A file with another column order, without ``status``, with the sender's
    ingest time and a column no field is declared for."""
    feed = binding.bronze_transactions(_events(spark, sf_dir))
    kept = [c for c in reversed(feed.columns) if c != "status"]
    note = F.concat(F.lit("note "), F.col("txn_id"))
    feed = feed.select(*kept, F.lit("2024-01-31").alias("_ingest_ts"), note.alias("sender note"))
    bronze = _land_and_ingest(spark, feed, feeds.TRANSACTION_FIELDS, "bronze-name", rescue=True)
    return bronze.select(*feeds.TRANSACTION_FIELDS, "ingest_ts", "rescued_data")


@query("bronze_drift")
def q_bronze_drift(spark, sf_dir):
    """The sender changes its files while the stream runs: an empty folder, then files
    as declared, then files in another order, without ``status`` and with
    a column more. The stream is started anew for each."""
    feed = binding.bronze_transactions(_events(spark, sf_dir))
    landing, table, ckpt = (scratch_path(spark, f"bronze-drift-{p}") for p in ("landing", "table", "checkpoint"))
    later = F.col("channel").isin("ONLINE", "POS", "MOBILE")
    kept = [c for c in reversed(feed.columns) if c != "status"]
    changed = feed.where(later).select(*kept, F.concat(F.lit("note "), F.col("txn_id")).alias("sender note"))
    for arrival in (None, feed.where(~later), changed):
        if arrival is not None:
            feeds.land_csv(arrival, landing)
        ingest.ingest_files(spark, landing, feeds.TRANSACTION_FIELDS, table, ckpt, rescue=True)
    return read_table(spark, table).select(*feeds.TRANSACTION_FIELDS, "rescued_data")


@query("bronze_lineage")
def q_bronze_lineage(spark, sf_dir):
    bronze = _land_and_ingest(
        spark, binding.bronze_transactions(_events(spark, sf_dir)), feeds.TRANSACTION_FIELDS, "bronze-lineage"
    )
    ok = (
        (F.col("file_name") == F.col("metadata.file_name"))
        & F.col("source_file").endswith(F.concat(F.lit("/"), F.col("file_name")))
        & F.col("ingest_timestamp").isNotNull()
    )
    return bronze.select("txn_id", ok.alias("lineage_ok"))


@query("scan_csv_batch")
def q_scan_csv_batch(spark, sf_dir):
    landing = scratch_path(spark, "csv-batch")
    feeds.land_csv(binding.bronze_sessions(_events(spark, sf_dir)), landing, mode="overwrite")
    return feeds.read_csv_batch(spark, landing).select(*feeds.SESSION_FIELDS)


@query("stream_customer_quarantine")
def q_stream_customer_quarantine(spark, sf_dir):
    feed = binding.bronze_customers(read_test_table(spark, sf_dir, "customer"), read_test_table(spark, sf_dir, "nation"))
    landing, bronze, quarantine = (scratch_path(spark, f"sq-{p}") for p in ("landing", "bronze", "quarantine"))
    feeds.land_csv(feed, landing, mode="overwrite")
    ingest.ingest_bronze(spark, landing, feeds.CUSTOMER_FIELDS, bronze, scratch_path(spark, "sq-ck1"))
    q = ingest.write_append(
        live.quarantine_customers_stream(live.table_stream(spark, bronze)), quarantine, scratch_path(spark, "sq-ck2")
    )
    q.awaitTermination()
    return spark.read.parquet(quarantine).select(*feeds.CUSTOMER_FIELDS, "error_reason")


@query("stream_velocity_1d")
def q_stream_velocity(spark, sf_dir):
    """Windowed counts from state, written to a published table batch by batch in two
    runs; windows that are still open at the end are in it, so it is the batch table."""
    landing, table, ckpt = (scratch_path(spark, f"vel-{p}") for p in ("landing", "table", "ck"))
    txns = binding.transactions(_events(spark, sf_dir))
    early = F.col("txn_timestamp") < F.lit("2024-01-15").cast("timestamp_ntz")
    for arrival in (txns.where(early), txns.where(~early)):
        arrival.write.mode("append").parquet(landing)
        live.run_velocity_windows(live.table_stream(spark, landing), table, ckpt, TEST_WIDE)
    return live.velocity_windows(spark, table, TEST_WIDE)


@query("stream_dedup_transactions")
def q_stream_dedup(spark, sf_dir):
    """Re-sent copies of a transaction collapse to the first one."""
    txns = binding.transactions(_events(spark, sf_dir))
    resent = txns.filter(F.col("txn_id").cast("bigint") % 61 == 0)
    landing, out = scratch_path(spark, "dedup-landing"), scratch_path(spark, "dedup-out")
    txns.unionByName(resent).write.parquet(landing)
    q = ingest.write_append(live.dedup_stream(live.table_stream(spark, landing), ["txn_id"], "txn_timestamp"), out,
                            scratch_path(spark, "dedup-ck"))
    q.awaitTermination()
    return spark.read.parquet(out)


@query("stream_latest_transactions")
def q_stream_latest(spark, sf_dir):
    """Newest copies by a stream: the copies of a transaction are dealt to three arrivals by their
    content, so newer ones come before or after older ones; equals ``silver_transactions``."""
    copies = binding.bronze_transactions(_events(spark, sf_dir))
    bronze, target, ckpt = (scratch_path(spark, f"latest-{p}") for p in ("bronze", "target", "ck"))
    merge = latest.latest_writer(target, ["txn_id"], ["txn_timestamp"], buckets=8)
    turn = F.pmod(F.xxhash64(*copies.columns), F.lit(3))
    for part in (2, 0, 1):
        append_table(copies.where(turn == part), bronze)
        run_table_stream(spark, bronze, lambda rows, n: merge(cleanse.silver_transactions(rows, AS_OF), n), ckpt)
    return latest.read_latest(spark, target)


@query("stream_scd2_customers")
def q_stream_scd2(spark, sf_dir):
    """Changes that arrive out of order (version 3, then 1, then 2), applied
    batch by batch; equals the batch rebuild."""
    changes = binding.customer_changes(read_test_table(spark, sf_dir, "customer"))
    days = [f"2024-01-0{version}" for version in (3, 1, 2)]
    return _stream_history(spark, changes, days, ["customer_id", "account_id"])


def _stream_history(spark, changes: DataFrame, days: list[str], keys: list[str]) -> DataFrame:
    """The history by a stream over a published silver table that gets the changes of
    each day, in the given order. The stream is started anew for each; after the
    first the table is rewritten (compacted), which is not replayed."""
    silver, target, ckpt = (scratch_path(spark, f"scd2-{p}") for p in ("silver", "target", "ck"))
    apply = scd2_stream.scd2_batch_writer(target, keys, "ingest_timestamp", buckets=16)
    for k, day in enumerate(days):
        append_table(changes.filter(F.to_date("ingest_timestamp") == F.lit(day).cast("date")), silver)
        run_table_stream(spark, silver, apply, ckpt)
        if k == 0:
            write_table(read_table(spark, silver), silver)
    return scd2_stream.read_history(spark, target)


@query("stream_scd2_transactions")
def q_stream_scd2_transactions(spark, sf_dir):
    """The re-ingest arrives before the first ingest."""
    changes = _two_ingests(cleanse.silver_transactions, binding.bronze_transactions(_events(spark, sf_dir)))
    return _stream_history(spark, changes, ["2024-02-02", "2024-02-01"], ["txn_id"])


@query("stream_scd2_sessions")
def q_stream_scd2_sessions(spark, sf_dir):
    changes = _two_ingests(cleanse.silver_sessions, binding.bronze_sessions(_events(spark, sf_dir)))
    return _stream_history(spark, changes, ["2024-02-02", "2024-02-01"], ["session_id"])
