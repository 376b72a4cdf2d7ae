"""Feeds with other columns than declared: matched by name, extras rescued, nothing shifted."""

import json

import pytest

from ledgerlake.config import scratch_path
from ledgerlake.sources import feeds
from ledgerlake.streaming import ingest

FIELDS = ("a", "b", "c")


def _ingest(spark, files, rescue=True):
    landing, table, ckpt = (scratch_path(spark, f"t-feed-{p}") for p in ("landing", "table", "ckpt"))
    for lines in files:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(landing)
    ingest.ingest_bronze(spark, landing, FIELDS, table, ckpt, rescue)
    return {r["a"]: r for r in spark.read.parquet(table).collect()}


def test_extra_missing_and_reordered_columns(spark):
    rows = _ingest(spark, [["c,_rescued_data,a,_ingest_ts,extra", "3,kept,1,2024-01-01,x", "6,,4,,", "9,,7,2024-01-02,y,toomany"]])
    assert (rows["1"]["b"], rows["1"]["c"], rows["1"]["ingest_ts"]) == (None, "3", "2024-01-01")
    assert json.loads(rows["1"]["rescued_data"]) == {"extra": "x"}
    assert rows["4"]["rescued_data"] is None
    assert rows["7"]["rescued_data"] == "9,,7,2024-01-02,y,toomany"


def test_sender_rescue_column_is_kept(spark):
    rows = _ingest(spark, [["a,b,c,_ingest_ts,_rescued_data", "1,2,3,t,left over"]])
    assert rows["1"]["rescued_data"] == "left over"


def test_without_rescue_extras_are_left_out(spark):
    rows = _ingest(spark, [["b,a,c,extra", "2,1,3,x"]], rescue=False)
    assert rows["1"]["b"] == "2" and "rescued_data" not in rows["1"].asDict()


def test_files_with_different_headers_are_an_error(spark):
    with pytest.raises(Exception):
        _ingest(spark, [["a,b,c", "1,2,3"], ["c,b,a", "6,5,4"]])
    assert feeds.raw_schema(FIELDS).fieldNames() == list(FIELDS)
