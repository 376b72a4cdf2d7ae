"""Slowly-changing dimension, type 2: history with ``__START_AT``/``__END_AT``.

Semantics (per key, ordered by the sequence column): ``__START_AT`` is the
row's own sequence value, ``__END_AT`` the next version's (NULL for the open
version). Rows with an equal (key, sequence) collapse to one. With
``track_columns`` a row equal (null-safe) to its predecessor on those
columns is not a new version.

Both ``lead`` and the change test run inside (key, segment) groups
(:func:`previous_by_segment`): a key with a huge number of versions (one of the
bounded top-k) is split by hour of its sequence, every other key is one
segment and needs no carry summary. The rows are shuffled and sorted once, on
(key, segment) and then by the sequence: duplicates collapse, and neighbours are
found, in that order. Only the rows of the split keys, which may hold millions of
copies, go through a partial aggregate before they move.

The incremental form (:func:`merge_increment`) rebuilds only the keys present
in a batch: their existing history is selected with a semi join and the rest
of the table passes through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleanse import latest_per_key
from .sequence import previous_by_segment, segment_of

START, END = "__START_AT", "__END_AT"


SEGMENT_SECONDS = 3600  # time slice of a hot key's versions
HOT_KEYS = 100_000  # at most this many keys are split (a bounded broadcast)
HOT_MIN_VERSIONS = 10_000  # ... and only keys with at least this many versions
UNSPLIT = -(2**63)


def _with_segments(rows: DataFrame, keys: list[str], sequence: str, hot_keys: int, hot_min_versions: int) -> DataFrame:
    """Hour segments for the keys with the most rows (bounded top-k),
    one segment (:data:`UNSPLIT`) for every other key."""
    hot = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__versions"))
        .filter(F.col("__versions") >= hot_min_versions)
        .orderBy(F.col("__versions").desc(), *keys)
        .limit(hot_keys)
        .select(*keys, F.lit(True).alias("__hot"))
    )
    seg = F.when(
        F.col("__hot"), segment_of(F.col(sequence).cast("timestamp_ntz"), SEGMENT_SECONDS)
    ).otherwise(F.lit(UNSPLIT))
    return rows.join(F.broadcast(hot), keys, "left").withColumn("__seg", seg.cast("bigint")).drop("__hot")


def rebuild(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    track_columns: Sequence[str] | None = None,
    hot_keys: int = HOT_KEYS,
    hot_min_versions: int = HOT_MIN_VERSIONS,
) -> DataFrame:
    """Full SCD2 history of ``changes`` (any mix of old and new rows).

    ``sequence`` must be a date/timestamp column (hour slices of it split
    the keys with the most versions across tasks).
    """
    keys = list(keys)
    cols = [c for c in changes.columns if c not in (START, END)]
    rows = _with_segments(changes.select(*cols), keys, sequence, hot_keys, hot_min_versions)
    split = [*keys, "__seg"]
    carried_only = F.col("__seg") != F.lit(UNSPLIT)  # single-segment keys need no carry
    # One row per (key, sequence), found where the rows of a (key, segment) lie. Sorting the
    # input before it moves would cost a task memory for all rows that it reads.
    alone = F.col("__seg").eqNullSafe(F.lit(UNSPLIT))
    version = [*split, sequence]
    rows = rows.filter(alone).unionByName(latest_per_key(rows.filter(~alone), version, [sequence]))
    rows = latest_per_key(rows.repartition(*split), version, [sequence])
    order = [sequence]
    if track_columns:
        tracked = [c for c in track_columns if c != sequence]
        carried = [*tracked, sequence]
        rows = previous_by_segment(rows, keys, "__seg", order, carried, "__was_", partition_keys=split,
                               summary_filter=carried_only)
        changed = F.col("__was_" + sequence).isNull()  # first version of the key
        for c in tracked:
            changed = changed | ~F.col(c).eqNullSafe(F.col("__was_" + c))
        rows = rows.filter(changed).drop(*["__was_" + c for c in carried])
    nxt = previous_by_segment(rows, keys, "__seg", order, [sequence], "__next_", reverse=True, partition_keys=split,
                          summary_filter=carried_only)
    return nxt.select(*cols, F.col(sequence).alias(START), F.col("__next_" + sequence).alias(END))


def current(history: DataFrame) -> DataFrame:
    """Open versions only (``__END_AT IS NULL``)."""
    return history.filter(F.col(END).isNull())


def tracked(history: DataFrame, keys: Sequence[str], sequence: str, track_columns: Sequence[str]) -> DataFrame:
    """A history without the versions that change none of ``track_columns``.

    A view over the complete history: dropping unchanged versions when they
    are stored would lose them, and a late row between two of them could not
    bring them back.
    """
    return rebuild(history.drop(START, END), keys, sequence, track_columns)


def merge_increment(history: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """New full history after applying ``batch``, late rows included. Only keys
    present in the batch are rebuilt; replaying the same batch gives the same
    table. ``history`` must hold every version (see :func:`tracked`)."""
    keys = list(keys)
    touched = batch.select(*keys).dropDuplicates()
    affected = history.join(touched, keys, "left_semi").drop(START, END)
    untouched = history.join(touched, keys, "left_anti")
    rebuilt = rebuild(affected.unionByName(batch.select(*affected.columns)), keys, sequence)
    return untouched.unionByName(rebuilt.select(*untouched.columns))
