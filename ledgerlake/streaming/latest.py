"""The newest copy of every key, kept from a stream.

``dropDuplicates`` on a stream keeps the copy that arrives first and forgets
a key with the watermark. Here the newest copy by an order column wins,
however late it or the older ones arrive: the result after any number of
batches is ``latest_per_key`` over all rows that ever arrived.

The table is bucketed by key (:func:`ledgerlake.sources.tables.write_buckets`)
and holds one row a key. The copies of a key are reduced by a partial aggregate, so a key with a third of all rows never meets in one
task. The rows of the touched buckets go through the same aggregate, and the buckets in
which a row of the batch won are published with the number of the batch; a replayed
batch is recognised by it. The batch and, if the table holds rows, the merge are
written once to a scratch folder, as each is read twice. A batch of which no row is newer than what the table
holds writes nothing, so a replay of old copies costs a read only.

Defined results: copies that are equal in the order column are decided by the
remaining columns (as in :func:`ledgerlake.operators.cleanse.latest_per_key`);
a null order value is older than any other; null keys are one key; an empty
batch changes nothing; columns that a later batch adds are not stored, columns it
lacks are null.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleanse import latest_per_key
from ..sources.tables import BUCKET, PART, Store, TableNotFound, bucket_count, last_batch, read_buckets, with_bucket, write_buckets

HELD = "__held"


def _ids(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most one a bucket


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def merge_latest(batch: DataFrame, target: str, keys: Sequence[str], newest: Sequence[str], batch_id: int, buckets: int = 64) -> list[int]:
    """Merge ``batch`` into the table at ``target`` (created if absent) as version
    ``batch_id``; returns the buckets that were written."""
    spark, keys = batch.sparkSession, list(keys)
    modulus, scratch = bucket_count(spark, target, buckets), f"scratch/merge-{uuid.uuid4().hex}"
    batch = _stored(batch, f"{target}/{scratch}/batch")
    touched = _ids(with_bucket(batch, keys, modulus))
    stored = read_buckets(spark, target)
    if stored is not None:
        missing = [f for f in stored.schema.fields if f.name not in batch.columns]
        batch = batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(*stored.columns)
    # Which of two equal rows stays is the last column: the one that is held.
    tagged = batch.withColumn(HELD, F.lit(False))
    held = read_buckets(spark, target, touched, ("buckets",)) if touched else None
    if held is not None:
        tagged = tagged.unionByName(held.withColumn(HELD, F.lit(True)))
    merged = with_bucket(latest_per_key(tagged, keys, newest), keys, modulus)
    if held is not None:
        merged = _stored(merged, f"{target}/{scratch}/merged")
        touched = _ids(merged.where(~F.col(HELD)))  # the others keep their rows
    if touched:
        rows = merged.where(F.col(BUCKET).isin(touched)).drop(HELD).withColumn(PART, F.lit("buckets"))
        write_buckets(rows, target, touched, batch_id, keys, modulus)
    Store(spark, target).delete(scratch)
    return touched


def latest_writer(target: str, keys: Sequence[str], newest: Sequence[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function, also for :func:`ledgerlake.streaming.table_log.run_table_stream`."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id > last_batch(batch.sparkSession, target):
            merge_latest(batch, target, keys, newest, batch_id, buckets)

    return apply


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """The newest copy of every key."""
    rows = read_buckets(spark, target)
    if rows is None:
        raise TableNotFound(target)
    return rows
