"""Stateless and windowed streaming operators over bronze/silver streams."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..operators.cleanse import quarantine_customers
from ..sources.tables import Store, last_batch, published, read_table, replace_parts


def table_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Append-only Parquet folder as a stream (only new files are seen, so
    update/delete commits of the source never reach the stream). Published
    tables are streamed by :func:`ledgerlake.streaming.table_log.run_table_stream`."""
    if published(spark, path) is not None:
        raise ValueError(f"{path} is a published table: use run_table_stream")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def quarantine_customers_stream(bronze_customers: DataFrame) -> DataFrame:
    """Customer quarantine as a stateless streaming filter."""
    return quarantine_customers(bronze_customers)


def event_time(wall_clock: Column) -> Column:
    """Watermarks need TIMESTAMP; map a wall-clock ``timestamp_ntz`` to the
    instant with that UTC wall clock (session-zone independent)."""
    return F.timestamp_seconds(F.unix_timestamp(wall_clock))


def wall_clock(instant: Column) -> Column:
    """Inverse of :func:`event_time`: UTC wall clock as ``timestamp_ntz``."""
    return F.timestamp_add("SECOND", F.unix_seconds(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def velocity_stream(txns: DataFrame, t: Thresholds = DEFAULT, delay: str = "15 minutes") -> DataFrame:
    """Tumbling-window transaction count per customer, append mode: a window
    is emitted once the watermark (max event time - ``delay``) passes its
    end; rows later than the watermark are dropped; state is evicted."""
    counted = (
        txns.withColumn("__event_time", event_time(F.col("txn_timestamp")))
        .withWatermark("__event_time", delay)
        .groupBy(F.window("__event_time", t.velocity_window), "customer_id")
        .count()
        .filter(F.col("count") > t.velocity_min_count)
    )
    return counted.select(
        wall_clock(F.col("window.start")).alias("window_start"),
        wall_clock(F.col("window.end")).alias("window_end"),
        "customer_id",
        "count",
    )


WINDOW_DAY = "window_date"


def run_velocity_windows(txns: DataFrame, path: str, checkpoint: str, t: Thresholds = DEFAULT, delay: str = "15 minutes") -> None:
    """Keep the counts of all windows, open ones too, in the published table ``path``.

    The stream runs in update mode: a batch emits the groups whose count changed,
    from state, and these replace theirs in the table. Only the days of these windows
    are read and written; a replayed batch is recognised by its number.
    """
    counted = (
        txns.withColumn("__event_time", event_time(F.col("txn_timestamp")))
        .withWatermark("__event_time", delay)
        .groupBy(F.window("__event_time", t.velocity_window), "customer_id")
        .count()
        .select(wall_clock(F.col("window.start")).alias("window_start"), wall_clock(F.col("window.end")).alias("window_end"), "customer_id", "count")
    )

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"scratch/batch-{uuid.uuid4().hex}"
        # Written once, also by a replay: running the batch is what commits its state.
        batch.withColumn(WINDOW_DAY, F.to_date("window_start")).write.parquet(f"{path}/{folder}")
        rows = spark.read.parquet(f"{path}/{folder}")
        days = sorted(r[0] for r in rows.select(WINDOW_DAY).distinct().collect())  # one row a day
        if days and batch_id > last_batch(spark, path):
            if published(spark, path) is not None:
                before = read_table(spark, path).where(F.col(WINDOW_DAY).isin(days))
                rows = rows.unionByName(before.join(rows, ["window_start", "customer_id"], "left_anti").select(*rows.columns))
            replace_parts(rows, path, WINDOW_DAY, days, batch_id)
        Store(spark, path).delete(folder)

    q = counted.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def velocity_windows(spark: SparkSession, path: str, t: Thresholds = DEFAULT) -> DataFrame:
    """The windows of :func:`run_velocity_windows` beyond the threshold, as of its last run."""
    return read_table(spark, path).where(F.col("count") > t.velocity_min_count).drop(WINDOW_DAY)


def open_windows(txns: DataFrame, t: Thresholds = DEFAULT, delay: str = "15 minutes") -> DataFrame:
    """The windows that :func:`velocity_stream` has not emitted at the end of
    the input ``txns`` (a batch): those the watermark has not passed. Together
    with the emitted ones they are the whole result."""
    last = F.expr(f"max(txn_timestamp) - INTERVAL {delay}")
    passed = txns.agg(last.alias("mark")).first()["mark"]
    if passed is None:
        passed = "1970-01-01 00:00:00"
    # Only rows of the last windows are counted again.
    recent = txns.filter(F.window("txn_timestamp", t.velocity_window)["end"] > F.lit(passed).cast("timestamp_ntz"))
    counted = recent.groupBy(F.window("txn_timestamp", t.velocity_window), "customer_id").count()
    return counted.filter(F.col("count") > t.velocity_min_count).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "customer_id", "count"
    )


def dedup_stream(rows: DataFrame, keys: Sequence[str], time_col: str, delay: str = "15 minutes") -> DataFrame:
    """Drop repeated keys arriving within ``delay`` of event time (first copy
    wins; state per key expires with the watermark)."""
    return (
        rows.withColumn("__event_time", event_time(F.col(time_col)))
        .withWatermark("__event_time", delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("__event_time")
    )
