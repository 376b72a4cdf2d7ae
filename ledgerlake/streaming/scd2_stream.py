"""Incremental SCD2 from a change stream with ``foreachBatch``.

The history is a table bucketed by key (:func:`ledgerlake.sources.tables.write_buckets`)
with two parts: open versions, one row a key, and closed ones. Each batch:

1. buckets its rows and lists the touched bucket ids (at most one small
   integer a bucket),
2. reads the open part of those buckets and finds the keys of the batch that
   arrive late, i.e. not after their open version,
3. rebuilds the keys of these buckets in one shuffle: a key without late rows from
   its open version alone (without rows in the batch that stays as it is), a late
   key from all its versions,
4. writes the open part of the touched buckets anew, adds the versions that
   were closed, and publishes both with the number of the batch. Closed parts
   are written again only for late keys' buckets, and merged when a bucket has
   collected ``MERGE_WRITES`` of them.

So the bytes of a batch follow the open rows of the buckets it touches, not the
length of the history. The number of buckets grows with the table; a bucket
with much of the data is written by several tasks.

A failure before the publication leaves the old version; a batch that was
published but not committed by the stream is recognised by its number and not
applied again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import scd2
from ..sources import tables
from ..sources.tables import BUCKET, PART, TableNotFound, bucket_count, last_batch, read_buckets, with_bucket, write_buckets

#: Writes of closed versions a bucket collects before they are merged into one.
MERGE_WRITES = 16


def _ids(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most one a bucket


def _crowded(spark, target: str, touched: Sequence[int]) -> set[int]:
    closed = (tables.published(spark, target) or (0, {}))[1].get("closed", {})
    return {b for b in touched if len(closed.get(str(b), [])) >= MERGE_WRITES}


def apply_changes(batch: DataFrame, target: str, keys: Sequence[str], sequence: str, batch_id: int, buckets: int = 1024) -> None:
    """Merge ``batch`` into the history at ``target`` (created if absent) as version ``batch_id``."""
    spark, keys = batch.sparkSession, list(keys)
    modulus = bucket_count(spark, target, buckets)
    touched = _ids(with_bucket(batch, keys, modulus))
    if not touched:
        return
    opened = read_buckets(spark, target, touched, ("buckets",))
    replaced: set[int] = set()
    scratch = None
    if opened is None:
        versions = scd2.rebuild(batch, keys, sequence)
        kept = None
    else:
        columns = opened.drop(scd2.START, scd2.END).columns
        rows = batch.select(*columns)
        first = rows.groupBy(*keys).agg(F.min(sequence).alias("__first"))
        late = opened.select(*keys, scd2.START).join(first, keys).where(F.col("__first") <= F.col(scd2.START)).select(*keys)
        # Read twice below (as bucket ids and as keys): written once. Its rows are keys of the batch.
        late, scratch = _stored(late, target)
        replaced = set(_ids(with_bucket(late, keys, modulus))) | _crowded(spark, target, touched)
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])  # a row without a key follows no other
        base, kept = opened.filter(keyed).select(*columns), opened.filter(~keyed)
        closed = read_buckets(spark, target, sorted(replaced), ("closed",)) if replaced else None
        if closed is not None:
            base = base.unionByName(closed.join(late, keys, "left_semi").select(*columns))
            kept = kept.unionByName(closed.join(late, keys, "left_anti").select(*kept.columns))
        versions = scd2.rebuild(base.unionByName(rows), keys, sequence)
    out = versions if kept is None else versions.unionByName(kept.select(*versions.columns))
    part = F.when(F.col(scd2.END).isNull(), "buckets").otherwise("closed").alias(PART)
    write_buckets(with_bucket(out, keys, modulus).select("*", part), target, touched, batch_id, keys, modulus, sorted(replaced))
    if scratch:
        tables.Store(spark, target).delete(scratch)


def _stored(df: DataFrame, target: str) -> tuple[DataFrame, str]:
    folder = f"scratch/late-{uuid.uuid4().hex}"
    df.write.parquet(f"{target}/{folder}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{target}/{folder}"), folder


def scd2_batch_writer(target: str, keys: Sequence[str], sequence: str, buckets: int = 1024) -> Callable[[DataFrame, int], None]:
    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id > last_batch(batch.sparkSession, target):
            apply_changes(batch, target, keys, sequence, batch_id, buckets)

    return apply


def run_scd2_stream(changes: DataFrame, target: str, checkpoint: str, keys: Sequence[str], sequence: str, buckets: int = 1024) -> None:
    """Drain ``changes`` (a streaming DataFrame) into the SCD2 table once."""
    q = (
        changes.writeStream.foreachBatch(scd2_batch_writer(target, keys, sequence, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def read_history(spark, target: str) -> DataFrame:
    """All versions."""
    history = read_buckets(spark, target)
    if history is None:
        raise TableNotFound(target)
    return history


def read_current(spark, target: str) -> DataFrame:
    """The open versions: only that part of the table is read."""
    history = read_buckets(spark, target, parts=("buckets",))
    if history is None:
        raise TableNotFound(target)
    return history
