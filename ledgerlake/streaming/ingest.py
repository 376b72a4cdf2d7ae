"""Bronze ingest streams: CSV directory -> Parquet table, exactly once.

Each new landing file is read once; the query's checkpoint (under the shared
``spark.checkpoint.dir``) records processed files and committed batches, so
a restarted or re-run job continues where it stopped and a lost executor only
re-runs its tasks. ``availableNow`` processes everything present and stops,
which suits scheduled runs; a long-running deployment passes a
processing-time trigger instead.

:func:`ingest_bronze` takes files of one header. :func:`ingest_files` takes
files as senders change them: each is parsed by its own header, a landing folder may
still be empty, and the result is a published table that others can stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.feeds import new_files, no_rows, read_csv_stream, read_files, with_lineage
from ..sources.tables import Store, append_table, last_batch, published


def bronze_stream(spark: SparkSession, landing: str, fields: Sequence[str], rescue: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming bronze DataFrame: declared strings, rescued records, lineage."""
    return with_lineage(read_csv_stream(spark, landing, fields, rescue, max_files_per_trigger=max_files_per_trigger))


def write_append(df: DataFrame, table_path: str, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append a streaming DataFrame to a Parquet table."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start(table_path)


def ingest_bronze(spark: SparkSession, landing: str, fields: Sequence[str], table_path: str, checkpoint: str,
                  rescue: bool = False, max_files_per_trigger: int | None = None) -> None:
    """Run one availableNow ingest of ``landing`` into ``table_path``."""
    q = write_append(bronze_stream(spark, landing, fields, rescue, max_files_per_trigger), table_path, checkpoint)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def ingest_files(spark: SparkSession, landing: str, fields: Sequence[str], table: str, checkpoint: str, rescue: bool = False,
                 max_files_per_trigger: int = 1000, sep: str = ",") -> None:
    """Append what landed since the last run to the published bronze table ``table``.

    A stream finds the new files, at most ``max_files_per_trigger`` a batch (the
    batch's list of names is held by the driver); the batch groups them by the header
    each one has and reads every layout by name. A batch is published with its
    number, so a replay adds nothing; a failed one leaves the table as it was.
    """
    Store(spark, landing).make()

    def apply(files: DataFrame, batch_id: int) -> None:
        if batch_id <= last_batch(spark, table):
            return
        names = [r["path"] for r in files.collect()]
        rows = read_files(spark, names, fields, rescue, sep) if names else None
        if rows is not None:
            append_table(with_lineage(rows), table, batch_id)

    q = (
        new_files(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    if published(spark, table) is None:
        append_table(with_lineage(no_rows(spark, landing, fields, rescue)), table)
