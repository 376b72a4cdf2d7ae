"""Streams survive failure: a crashed micro-batch is replayed from the
checkpoint and the result equals the batch computation."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.config import scratch_path
from ledgerlake.operators import scd2
from ledgerlake.sources import binding
from ledgerlake.streaming import live, scd2_stream

KEYS = ["customer_id", "account_id"]


def test_scd2_stream_recovers_from_a_failed_batch(spark):
    changes = binding.customer_changes(spark.read.parquet("/root/testdata/sf0.001/customer.parquet"))
    landing, target, ckpt = (scratch_path(spark, f"t-scd2-{p}") for p in ("landing", "target", "ckpt"))
    day = F.datediff(F.to_date("ingest_timestamp"), F.lit("2024-01-01").cast("date"))
    for version in (2, 3, 1):
        changes.filter(day == version - 1).coalesce(1).write.mode("append").parquet(landing)

    good = scd2_stream.scd2_batch_writer(target, KEYS, "ingest_timestamp", buckets=4)

    def crashing(batch, batch_id):
        good(batch, batch_id)  # the batch's table write happens ...
        if batch_id == 1:
            raise RuntimeError("executor lost")  # ... but the batch is never committed

    q = (live.table_stream(spark, landing, max_files_per_trigger=1).writeStream.foreachBatch(crashing)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    with pytest.raises(Exception):
        q.awaitTermination()

    scd2_stream.run_scd2_stream(live.table_stream(spark, landing, max_files_per_trigger=1), target, ckpt, KEYS,
                                "ingest_timestamp", buckets=4)
    got = scd2_stream.read_history(spark, target)
    want = scd2.rebuild(changes, KEYS, "ingest_timestamp")
    assert got.count() == want.count() == 3 * changes.select(*KEYS).distinct().count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
