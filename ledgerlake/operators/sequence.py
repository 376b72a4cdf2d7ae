"""Order-dependent operators that stay bounded under key skew.

A plain ``Window.partitionBy(customer)`` sends every row of a customer to
one task; if one customer holds a third of the table that task holds a third
of the table. The operators here never partition row-level work by the bare
entity key:

* ``previous_by_segment`` — ``lag`` over an entity, computed inside
  (entity, segment) groups, a segment being a short time slice (a minute by
  default). The first row of a segment takes its predecessor from a
  one-row-per-(entity, segment) summary, whose own ``lag`` runs over at most
  one row per active segment of the entity (bounded by time span, not by
  the entity's row count).
* ``trailing_sum`` — a ``RANGE BETWEEN span PRECEDING AND CURRENT ROW`` sum,
  evaluated as a linear sweep of +v/-v events over (entity, block) groups.
* ``forward_payees_and_total`` — for probe times ``c``: distinct payees and
  total of transfers in ``[c, c + span]``, as a sweep over merged intervals.

Spark evaluates a sliding RANGE frame by re-aggregating the whole frame for
every row (quadratic for a busy entity); both sweeps only use running sums
(UNBOUNDED PRECEDING), which Spark evaluates incrementally. All operators are
plain DataFrame plans (aggregate, window, join), so Catalyst prunes columns
and pushes filters through them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _join_back(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hint: str | None = None,
    partition_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Plain equi-join on column names. A null-safe (``<=>``) join would be
    planned on rewritten key expressions and lose the co-partitioning, so
    keys are required to be non-null (fill them first).

    ``partition_keys`` (a subset of ``keys``) is how ``left`` is
    hash-partitioned; ``right`` is shuffled the same way first. Without it
    Spark may adopt the right side's coarser partitioning and rewrite the
    left side's shuffle to match, undoing the split of hot keys.
    """
    if partition_keys:
        right = right.repartition(*partition_keys)
    if hint:
        right = right.hint(hint)
    return left.join(right, list(keys), how)


def segment_of(ts: Column, seconds: int) -> Column:
    """Segment index of a timestamp: ``floor(epoch_seconds / seconds)``."""
    return F.floor(F.unix_timestamp(ts) / F.lit(seconds))


def previous_by_segment(
    df: DataFrame,
    keys: Sequence[str],
    segment: str | Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    prefix: str = "prev_",
    summary_source: DataFrame | None = None,
    join_hint: str | None = "merge",
    reverse: bool = False,
    partition_keys: Sequence[str] | None = None,
    summary_filter: Column | None = None,
) -> DataFrame:
    """Add ``prefix + v`` = value ``v`` of the previous row of the same ``keys``.

    "Previous" follows ``order`` (ascending, all columns; include a unique
    column so ties are deterministic). ``segment`` (one or more columns, e.g.
    a day or a minute index) must be non-decreasing in ``order`` within a
    key. Result equals ``lag(v).over(Window.partitionBy(keys).orderBy(order))``
    for non-null ``keys`` and segments; with ``reverse=True`` it is the next
    row instead (``lead``).

    Row-level work is partitioned by (keys, segment); only the summary of one
    row per (key, segment) is ordered per key, so its size is bounded by the
    number of active segments of a key, not by its row count.

    ``summary_source`` (default ``df``) is where the per-(key, segment)
    summary is read from; pass an earlier DataFrame of the same rows to keep
    the summary branch from recomputing windows already applied to ``df``.

    ``partition_keys``: how ``df`` is already hash-partitioned (a subset of
    keys + segment). When omitted, ``df`` is repartitioned on keys + segment
    here. Either way the summary is shuffled to the same partitioning before
    the join, so the row-level split is never replaced by a coarser one.

    ``summary_filter`` restricts the summary to rows of entities that span
    several segments; an entity with a single segment never needs a carry,
    so leaving it out of the summary changes nothing but its size.
    """
    keys, order, values = list(keys), list(order), list(values)
    seg_cols = [segment] if isinstance(segment, str) else list(segment)
    if partition_keys is None:
        partition_keys = [*keys, *seg_cols]
        df = df.repartition(*partition_keys)
    direction = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    # Ascending in both directions: rows that already lie in this order are not sorted again.
    seg = Window.partitionBy(*keys, *seg_cols).orderBy(*order)
    beside = F.lead if reverse else F.lag
    tmp = {v: f"__in_{v}" for v in values}
    out = df
    for v in values:
        out = out.withColumn(tmp[v], beside(v).over(seg))
    out = out.withColumn("__seg_first", beside(F.lit(True)).over(seg).isNull())

    # One row per (key, segment): the segment's last row (first, when
    # reversed), then that row of the neighbouring active segment of the key.
    src = df if summary_source is None else summary_source
    if summary_filter is not None:
        src = src.filter(summary_filter)
    edge_max, edge_by = (F.min, F.min_by) if reverse else (F.max, F.max_by)
    if values == order[:1]:
        # Only the leading order column is needed: a plain max/min (hash aggregate).
        last_value = F.struct(edge_max(values[0]).alias(values[0]))
    else:
        last_value = edge_by(F.struct(*[F.col(v).alias(v) for v in values]), F.struct(*order))
    last = src.groupBy(*keys, *seg_cols).agg(last_value.alias("__last"))
    carry = last.select(
        *keys,
        *seg_cols,
        F.lag("__last").over(Window.partitionBy(*keys).orderBy(*[direction(c) for c in seg_cols])).alias("__carry"),
    )
    out = _join_back(out, carry, [*keys, *seg_cols], hint=join_hint, partition_keys=partition_keys)
    for v in values:
        out = out.withColumn(
            prefix + v,
            F.when(F.col("__seg_first"), F.col("__carry").getField(v)).otherwise(F.col(tmp[v])),
        )
    return out.drop("__seg_first", "__carry", *tmp.values())


def _running_sum(events: DataFrame, partition: Sequence, time: str, deltas: Sequence[str]) -> DataFrame:
    """Running sums of ``deltas`` over ``time`` (peers included). An
    UNBOUNDED PRECEDING frame is evaluated incrementally by Spark, unlike a
    sliding RANGE frame, which re-aggregates the whole frame for every row."""
    w = Window.partitionBy(*partition).orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    for d in deltas:
        events = events.withColumn(d, F.sum(d).over(w))
    return events


def trailing_sum(
    df: DataFrame,
    keys: Sequence[str],
    seconds: str,
    value: str,
    span: int,
    name: str,
    carry_cols: Sequence[str] = (),
) -> DataFrame:
    """Per (keys, second): sum of ``value`` over the key's rows whose
    ``seconds`` lies in ``[s - span, s]`` (both ends included).

    Returns one row per distinct (keys, carry_cols, seconds) - join it back on
    those columns. ``carry_cols`` must be functionally dependent on
    ``seconds`` (e.g. a segment index); they only keep the join co-partitioned.

    Linear sweep: every per-second value enters the window as ``+v`` at ``s``
    and leaves as ``-v`` at ``s + span + 1``, so the running sum of events up
    to ``s`` is the window sum. Seconds are grouped in blocks of one span;
    block ``k`` also receives the events of block ``k - 1`` (the only earlier
    rows that can still be inside a window ending in block ``k``), so a
    partition never holds more than two spans of one key.
    """
    keys, carry_cols = list(keys), list(carry_cols)
    per_second = df.groupBy(*keys, *carry_cols, seconds).agg(F.sum(value).alias("__v"))
    block = F.floor(F.col(seconds) / F.lit(span))
    events = per_second.select(
        *keys,
        *carry_cols,
        seconds,
        F.explode(
            F.array(
                # (block, event time, delta, is the output row)
                F.struct(block.alias("b"), F.col(seconds).alias("t"), F.col("__v").alias("d"), F.lit(True).alias("o")),
                F.struct((block + 1).alias("b"), F.col(seconds).alias("t"), F.col("__v").alias("d"),
                         F.lit(False).alias("o")),
                F.struct(block.alias("b"), (F.col(seconds) + span + 1).alias("t"), (-F.col("__v")).alias("d"),
                         F.lit(False).alias("o")),
                F.struct((block + 1).alias("b"), (F.col(seconds) + span + 1).alias("t"), (-F.col("__v")).alias("d"),
                         F.lit(False).alias("o")),
            )
        ).alias("__e"),
    ).select(*keys, *carry_cols, seconds, "__e.*")
    swept = _running_sum(events, [*keys, "b"], "t", ["d"])
    return swept.filter(F.col("o")).select(*keys, *carry_cols, seconds, F.col("d").alias(name))


def forward_payees_and_total(
    probes: DataFrame,
    transfers: DataFrame,
    keys: Sequence[str],
    seconds: str,
    payee: str,
    amount: str,
    span: int,
) -> DataFrame:
    """For each probe second ``c``: distinct ``payee`` values and total
    ``amount`` of the key's transfers with seconds in ``[c, c + span]``.

    Returns the probe rows plus ``__payees`` (bigint) and ``__amount``. A probe
    without key or second has no transfers: 0 and 0.

    Linear sweep, no pairs: a transfer at ``t`` covers probe times
    ``[t - span, t]``. Per (key, block, payee) the covering intervals are
    merged (``lag``/``lead`` inside the block), so a ``+1`` at each merged
    start and ``-1`` after each merged end count distinct payees; ``+amount``
    at ``t - span`` and ``-amount`` at ``t + 1`` give the total. Probes in
    block ``k`` only need transfers of blocks ``k`` and ``k + 1``, so each
    transfer is placed in its own block and the one before it.

    No group grows with the rows of a key: the merge holds one row a second of
    a payee, and the sweep one row a second of a block (:func:`second_deltas`),
    whatever number of payees and transfers met in it. These rows come from partial
    aggregates, so a key that holds much of the data in one block is summed
    by all tasks that read it.
    """
    keys = list(keys)
    deltas = second_deltas(probes, transfers, keys, seconds, payee, amount, span)
    swept = _running_sum(deltas, [*keys, "__b"], "__time", ["__dp", "__da"]).filter("__probe")
    found = swept.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__time").alias("__k_s"), F.col("__dp").cast("bigint").alias("__payees"), F.col("__da").alias("__amount")
    )
    same = F.col(seconds) == F.col("__k_s")
    for k in keys:
        same &= F.col(k) == F.col(f"__k_{k}")
    return probes.join(found, same, "left").select(
        *keys, *[c for c in probes.columns if c not in keys], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("__payees", "__amount")]
    )


def second_deltas(
    probes: DataFrame, transfers: DataFrame, keys: Sequence[str], seconds: str, payee: str, amount: str, span: int
) -> DataFrame:
    """What changes at each second of a (key, block ``__b``): ``__dp`` payees and
    ``__da`` amount, and whether a probe asks there (``__probe``). At most
    ``3 * span + 1`` rows a block, one a second."""
    keys = list(keys)
    per_second = transfers.groupBy(*keys, payee, F.col(seconds).alias("__t")).agg(F.sum(amount).alias("__a"))
    block = F.floor(F.col("__t") / F.lit(span))
    copies = per_second.select("*", F.explode(F.array(block, block - 1)).alias("__b"))
    by_payee = Window.partitionBy(*keys, "__b", payee).orderBy("__t")
    copies = copies.withColumn("__prev", F.lag("__t").over(by_payee)).withColumn(
        "__next", F.lead("__t").over(by_payee)
    )
    starts = F.col("__prev").isNull() | (F.col("__prev") < F.col("__t") - span)
    ends = F.col("__next").isNull() | (F.col("__next") > F.col("__t") + span)
    events = copies.select(
        *keys,
        "__b",
        F.explode(
            F.array(
                F.struct((F.col("__t") - span).alias("__time"), F.when(starts, 1).otherwise(0).alias("__dp"),
                         F.col("__a").alias("__da")),
                F.struct((F.col("__t") + 1).alias("__time"), F.when(ends, -1).otherwise(0).alias("__dp"),
                         (-F.col("__a")).alias("__da")),
            )
        ).alias("__e"),
    ).select(*keys, "__b", "__e.*", F.lit(False).alias("__probe"))
    asked = probes.select(
        *keys,
        F.floor(F.col(seconds) / F.lit(span)).alias("__b"),
        F.col(seconds).alias("__time"),
        F.lit(0).alias("__dp"),
        F.lit(0).cast(events.schema["__da"].dataType).alias("__da"),
        F.lit(True).alias("__probe"),
    )
    return events.unionByName(asked).groupBy(*keys, "__b", "__time").agg(
        F.sum("__dp").alias("__dp"), F.sum("__da").alias("__da"), F.max("__probe").alias("__probe")
    )
