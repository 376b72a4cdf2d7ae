"""Published tables as streams.

A published table's log has one small file a version. A file stream over the
log finds new versions exactly once (its checkpoint knows the entries it has
read), and ``foreachBatch`` resolves each entry to the folders the version
appended. Versions that rewrote the table (a recomputation, a compaction)
add no rows: they are skipped, or an error on request. The log is kept, so a
stream may lie idle for any number of versions; the folders of appended rows
stay as long as the table holds them, and a stream that comes after a rewrite
has removed unread ones fails with their names instead of missing rows.

The first batch of a new checkpoint is the table as it was when the
stream first started.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import ConcurrentWrite, Store, TableNotFound, folders, published, read_folders

Apply = Callable[[DataFrame, int], None]


class RewrittenTable(RuntimeError):
    """The table was rewritten and the stream was told not to skip that."""


class MissingRows(RuntimeError):
    """A rewrite removed appended rows before the stream read them."""


def _start(spark: SparkSession, path: str, checkpoint: str) -> dict:
    """The version the stream starts with, fixed by its first run."""
    store = Store(spark, checkpoint)
    if not store.exists("start.json"):
        found = published(spark, path)
        if found is None:
            raise TableNotFound(path)
        number, content = found
        start = {"version": number, "added": _whole(content, path), "schema": content["schema"]}
        try:
            store.create("start.json", json.dumps(start))
        except ConcurrentWrite:  # another run of this stream started first
            pass
    return json.loads(store.read("start.json"))


def _whole(content: dict, path: str) -> list[str]:
    if "data" not in content and "folders" not in content or content.get("partition_by"):
        raise ValueError(f"only unpartitioned tables can be streamed: {path}")
    return folders(content)


def versions_writer(path: str, start: dict, apply: Apply, rewrites: str = "skip") -> Apply:
    """A ``foreachBatch`` function over log entries that hands ``apply`` the rows they added."""

    def run(entries: DataFrame, batch_id: int) -> None:
        spark = entries.sparkSession
        found = sorted((json.loads(r["value"]) for r in entries.collect()), key=lambda e: e["version"])  # one row a version
        found = [e for e in found if e["version"] >= start["version"]]
        added: list[tuple[str, dict]] = []
        for entry in found:
            if entry["version"] == start["version"]:
                entry = start
            elif entry["kind"] != "append":
                if rewrites != "skip":
                    raise RewrittenTable(f"{path} version {entry['version']}")
                continue
            added += [(folder, entry["schema"]) for folder in entry["added"]]
        if not added:
            return
        store = Store(spark, path)
        gone = [folder for folder, _ in added if not store.exists(folder)]
        if gone:
            raise MissingRows(f"{path}: {', '.join(gone)}")
        by_schema: dict[str, list[str]] = {}
        for folder, schema in added:
            by_schema.setdefault(json.dumps(schema, sort_keys=True), []).append(folder)
        rows = None
        for schema, names in by_schema.items():
            part = read_folders(spark, path, names, json.loads(schema))
            rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
        apply(rows, batch_id)

    return run


def run_table_stream(spark: SparkSession, path: str, apply: Apply, checkpoint: str, rewrites: str = "skip",
                     versions_per_batch: int = 100) -> None:
    """Hand ``apply(rows, batch number)`` everything the published table at ``path``
    got since the last run with this checkpoint. ``rewrites``: "skip" or "error"."""
    start = _start(spark, path, checkpoint)
    entries = spark.readStream.schema("value string").option("maxFilesPerTrigger", versions_per_batch).text(f"{path}/log")
    q = (
        entries.writeStream.foreachBatch(versions_writer(path, start, apply, rewrites))
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()
