"""Published tables as streams: appended rows once, rewrites never."""

import threading

import pytest
from pyspark.sql import functions as F

from ledgerlake.config import scratch_path
from ledgerlake.sources import tables
from ledgerlake.streaming import live
from ledgerlake.streaming.table_log import MissingRows, RewrittenTable, run_table_stream


def rows(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


class Reader:
    def __init__(self, spark, path):
        self.spark, self.path, self.ckpt, self.got = spark, path, scratch_path(spark, "t-log-ckpt"), []

    def run(self, **options):
        def apply(df, batch_id):
            self.got += [r["id"] for r in df.collect()]

        run_table_stream(self.spark, self.path, apply, self.ckpt, **options)
        return sorted(self.got)


def test_appended_rows_once_and_rewrites_never(spark):
    path = scratch_path(spark, "t-log")
    tables.write_table(rows(spark, 1, 2), path)
    tables.append_table(rows(spark, 3), path)
    reader = Reader(spark, path)
    assert reader.run() == [1, 2, 3]  # the table as it was at the first run
    assert reader.run() == [1, 2, 3]
    tables.append_table(rows(spark, 4), path)
    tables.append_table(rows(spark, 5), path)
    assert reader.run(versions_per_batch=1) == [1, 2, 3, 4, 5]
    tables.write_table(tables.read_table(spark, path).where("id > 2"), path)  # rows deleted: no replay
    assert reader.run() == [1, 2, 3, 4, 5]
    for k in range(6, 10):  # more versions than are kept
        tables.append_table(rows(spark, k), path)
    assert reader.run() == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert sorted(r["id"] for r in tables.read_table(spark, path).collect()) == [3, 4, 5, 6, 7, 8, 9]
    tables.write_table(rows(spark, 1), path)
    with pytest.raises(Exception, match=RewrittenTable.__name__):
        reader.run(rewrites="error")


def test_rows_that_a_rewrite_removed_are_an_error(spark):
    path = scratch_path(spark, "t-log")
    tables.write_table(rows(spark, 1), path)
    reader = Reader(spark, path)
    reader.run()
    tables.append_table(rows(spark, 2), path)
    for _ in range(tables.KEEP):
        tables.write_table(tables.read_table(spark, path), path)
    with pytest.raises(Exception, match=MissingRows.__name__):
        reader.run()


def test_columns_may_be_added(spark):
    path = scratch_path(spark, "t-log")
    tables.append_table(rows(spark, 1), path)
    tables.append_table(rows(spark, 2).withColumn("more", F.lit("x")), path)
    seen = []
    run_table_stream(spark, path, lambda df, n: seen.extend(map(tuple, df.collect())), scratch_path(spark, "t-log-ckpt"))
    assert sorted(seen) == [(1, None), (2, "x")]


def test_numbered_batches_are_added_once(spark):
    path = scratch_path(spark, "t-log")
    assert [tables.append_table(rows(spark, n), path, batch_id=n) for n in (0, 1, 1, 0, 2)] == [True, True, False, False, True]
    assert sorted(r["id"] for r in tables.read_table(spark, path).collect()) == [0, 1, 2]


def test_lost_log_entry_is_written_by_the_next_writer(spark, monkeypatch):
    path = scratch_path(spark, "t-log")
    tables.append_table(rows(spark, 1), path)
    reader = Reader(spark, path)
    reader.run()
    with monkeypatch.context() as m:  # the driver is lost right after the publication
        m.setattr(tables, "_log", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            tables.append_table(rows(spark, 2), path)
    assert reader.run() == [1]
    tables.append_table(rows(spark, 3), path)
    assert reader.run() == [1, 2, 3]


def test_racing_writers_one_wins_each_version(spark):
    path = scratch_path(spark, "t-race")
    won, lost, gate = [], [], threading.Barrier(8)

    def write(me):
        store = tables.Store(spark, path)
        for n in range(12):
            gate.wait()
            try:
                store.create(f"published/{n:010d}.json", '{"by": %d}' % me)
                won.append((n, me))
            except tables.ConcurrentWrite:
                lost.append((n, me))

    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(n for n, _ in won) == list(range(12)) and len(lost) == 12 * 7
    store = tables.Store(spark, path)
    assert all(store.read(f"published/{n:010d}.json") == '{"by": %d}' % me for n, me in won)
    assert store.names("drafts") == []


def test_racing_appends_lose_no_rows(spark):
    path = scratch_path(spark, "t-race")
    tables.append_table(rows(spark, 0), path)
    done = []

    def write(k):
        while True:
            try:
                tables.append_table(rows(spark, k), path)
                done.append(k)
                return
            except tables.ConcurrentWrite:
                continue

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r["id"] for r in tables.read_table(spark, path).collect()) == [0, 1, 2, 3, 4]


def test_folder_stream_names_the_right_function(spark):
    path = scratch_path(spark, "t-log")
    tables.write_table(rows(spark, 1), path)
    with pytest.raises(ValueError, match="run_table_stream"):
        live.table_stream(spark, path)
