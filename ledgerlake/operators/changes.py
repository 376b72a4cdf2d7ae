"""What differs between two states of a table, without moving its rows.

Rows of the new state count +1, those of the old one -1, and every row adds
its signed digests to its group. A group whose sums are all zero holds the same
rows in both states (as a multiset; two independent 64-bit digests). The sums
are partial aggregates, so only one narrow row a group and task is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_groups(old: DataFrame, new: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The ``groups`` values whose rows, by ``columns``, are not the same in both states."""

    def signed(df: DataFrame, sign: int) -> DataFrame:
        digests = (F.xxhash64(*columns), F.xxhash64(F.lit(sign * sign), *reversed(columns)))
        wide = [(d.cast("decimal(20,0)") * F.lit(sign)).alias(f"__d{k}") for k, d in enumerate(digests)]
        return df.select(*groups, *wide, F.lit(sign).cast("bigint").alias("__n"))

    sums = [F.sum(c).alias(c) for c in ("__d0", "__d1", "__n")]
    differs = (F.col("__d0") != 0) | (F.col("__d1") != 0) | (F.col("__n") != 0)
    return signed(new, 1).unionByName(signed(old, -1)).groupBy(*groups).agg(*sums).where(differs).select(*groups)
