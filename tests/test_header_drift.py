"""Files whose headers differ, arriving at one running ingest."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.config import scratch_path
from ledgerlake.sources import feeds, tables
from ledgerlake.streaming import ingest

FIELDS = ("a", "b", "c")


class Landing:
    def __init__(self, spark, **options):
        self.spark, self.options = spark, options
        self.folder, self.table, self.ckpt = (scratch_path(spark, f"t-drift-{p}") for p in ("landing", "table", "ckpt"))

    def land(self, *lines):
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(self.folder)

    def ingest(self, rescue=True):
        ingest.ingest_files(self.spark, self.folder, FIELDS, self.table, self.ckpt, rescue, **self.options)
        return {r["a"]: r for r in tables.read_table(self.spark, self.table).collect()}


def test_every_file_has_its_own_header(spark):
    feed = Landing(spark)
    assert feed.ingest() == {}
    feed.land("a,b,c", "1,2,3")
    feed.land("c,extra,a,_ingest_ts", "6,x,4,2024-01-01", "9,,7,")
    rows = feed.ingest()
    assert (rows["1"]["b"], rows["1"]["c"], rows["1"]["rescued_data"]) == ("2", "3", None)
    assert (rows["4"]["b"], rows["4"]["c"], rows["4"]["ingest_ts"]) == (None, "6", "2024-01-01")
    assert json.loads(rows["4"]["rescued_data"]) == {"extra": "x"} and rows["7"]["rescued_data"] is None
    feed.land("b,a,c,more", "11,10,12,13", "15,14,16,17,18")  # the ingest starts anew
    rows = feed.ingest()
    assert sorted(rows) == ["1", "10", "14", "4", "7"]
    assert rows["10"]["b"] == "11" and json.loads(rows["10"]["rescued_data"]) == {"more": "13"}
    assert rows["14"]["rescued_data"] == "15,14,16,17,18"
    assert all(r["file_name"] and r["source_file"].endswith(r["file_name"]) for r in rows.values())


def test_odd_files(spark):
    feed = Landing(spark)
    feed.land("")  # a file of one empty line
    feed.spark.createDataFrame([], "value string").write.mode("append").text(feed.folder)
    feed.land("﻿a,,b,A,c", "1,x,2,y,3")
    feed.land('"a","b,b",c', '5,"6",7')
    feed.land("b,a,c")  # a header alone
    rows = {k: v for k, v in feed.ingest().items() if k is not None}
    assert set(rows) == {"1", "5"} and (rows["1"]["b"], rows["1"]["c"]) == ("2", "3")
    assert json.loads(rows["1"]["rescued_data"]) == {"_c1": "x", "A_3": "y"}
    assert json.loads(rows["5"]["rescued_data"]) == {"b,b": "6"}
    assert feeds.header_columns("") == ["_c0"] and feeds.header_columns("x;y", ";") == ["x", "y"]


def test_without_rescue_extras_are_left_out(spark):
    feed = Landing(spark)
    feed.land("b,a,c,extra", "2,1,3,x")
    row = feed.ingest(rescue=False)["1"]
    assert row["b"] == "2" and "rescued_data" not in row.asDict()


def test_crash_between_publication_and_commit(spark, monkeypatch):
    feed = Landing(spark, max_files_per_trigger=1)
    for k in range(3):
        feed.land("a,b,c" if k else "c,b,a", f"{k},y,{k}")
    append = tables.append_table

    def crashing(df, path, batch_id=None):
        done = append(df, path, batch_id)
        if batch_id == 1:
            raise RuntimeError("driver lost")
        return done

    with monkeypatch.context() as m:
        m.setattr(ingest, "append_table", crashing)
        with pytest.raises(Exception):
            feed.ingest()
    assert sorted(feed.ingest()) == ["0", "1", "2"]
    assert tables.read_table(spark, feed.table).count() == 3


def test_header_is_the_first_line_of_a_split_file(spark):
    feed = Landing(spark)
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("c"), F.lit("x" * 30).alias("b"), (F.col("id") + 1).cast("string").alias("a"))
    rows.coalesce(1).write.option("header", True).csv(feed.folder)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        ingest.ingest_files(spark, feed.folder, FIELDS, feed.table, feed.ckpt)
        got = tables.read_table(spark, feed.table)
        assert got.count() == 30_000 and got.where("cast(a as int) = cast(c as int) + 1").count() == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
