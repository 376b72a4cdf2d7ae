"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a share of the word budget by its weight, stops at
``max_epochs`` times its own size, and hands its excess to the others by
weight (water filling). A source's target is met by whole epochs first; the
rest is a weighted sample without replacement: each document draws an
exponential key ``-ln(u) / weight``, keys are sorted within the source, and
documents are taken in that order until the prefix sum of their words reaches
the rest. The last one taken is cut to the words still wanted.

``u`` comes from an MD5 of the id and the text, so reruns agree.

Scale: the text is read once; afterwards only (id, source, size, key) rows
move. A source's keys are cut into ranges, and the prefix sum is a window inside one
range plus the sum of the ranges before it, so a source with a third of all rows
spreads over as many tasks as it has ranges. The ranges are equal steps of the
logarithm of the key: a weight only shifts that logarithm, and whatever weights a
source mixes, its density is nowhere above 1/e. So no range is expected to hold more than
``rows_per_range`` rows, for any quality weights and without sampling the keys;
those far from the middle hold fewer.

Defined results: a null text has size 0; a null source is a source of its
own, after all others; documents of size 0 take 0 words; a source without
words has target 0; repeated rows are documents of their own; an empty table
gives an empty result. Input columns other than the id are not returned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_WS, materialised

#: Source tables up to this many rows may be broadcast (about 100 bytes each).
BROADCAST_SOURCES = 100_000
# Characters that lower a document's quality weight.
SYMBOLS = "#*$%&|<>"


def quality_weight(text: Column) -> Column:
    """1 for plain text, falling with the share of symbol characters."""
    chars = F.length(F.coalesce(text, F.lit("")))
    plain = F.length(F.translate(F.coalesce(text, F.lit("")), SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(10.0) * (chars - plain) / F.greatest(chars, F.lit(1)))


def uniform(*parts: Column) -> Column:
    """A number strictly between 0 and 1 from 52 bits of an MD5."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """``sizes(source, source_size)`` plus ``target``: one row per source, so
    the ordered windows below are over sources, never over documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = weighted.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share))).withColumn(
        "level",
        (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest),
    )
    # The first source (by ratio) that the level of the remaining sources does not fill is where the water stands.
    open_level = F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", F.col("source").isNull(), "source", "level"))
    level = F.min(open_level).over(everything)["level"]
    return levels.withColumn("water", level).select(
        "source",
        "source_size",
        F.coalesce(F.least("cap", F.col("weight") * F.col("water")), F.col("cap")).alias("target"),
        F.col("n_docs"),
    )


def key_range(draw_key: Column, n_docs: Column, rows_per_range: int) -> Column:
    """Number of the range of a draw key, rising with it. ``-ln(u) / weight`` has the log-density
    ``y * exp(-y)`` with ``y = weight * key``, at most 1/e: a step of ``e * rows_per_range / n_docs``
    is expected to hold at most ``rows_per_range`` of ``n_docs`` rows."""
    return F.floor(F.log(draw_key) * (n_docs / F.lit(math.e * rows_per_range)))


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: float = 2.0,
    quality: Column | None = None,
    rows_per_range: int = 4096,
) -> DataFrame:
    """``(id, source, size, source_size, target, taken, draw_key)`` per row of ``docs``."""
    text = F.col(text_col)
    sized = materialised(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD_WS)), F.lit(0)).cast("bigint").alias("size"),
            (
                -F.log(uniform(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")))))
                / (quality if quality is not None else quality_weight(text))
            ).alias("draw_key"),
        ),
        "mix-sizes",
    )
    sizes = sized.groupBy("source").agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    targets = materialised(source_targets(sizes, weights, share, max_epochs), "mix-targets")
    plan = targets.select(
        F.col("source").alias("t_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).alias("epochs"),
        "n_docs",
    ).withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint"))
    if targets.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    keyed = (
        sized.join(plan, F.col("source").eqNullSafe(F.col("t_source")), "left")
        .drop("t_source")
        .withColumn("range", key_range(F.col("draw_key"), F.col("n_docs"), rows_per_range))
    )
    # Words of the ranges before each range: one row per (source, range).
    ranges = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        F.col("source").alias("s_source"),
        F.col("range").alias("s_range"),
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start"),
    )
    within = (
        Window.partitionBy("source", "range")
        .orderBy("draw_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = keyed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("range") == F.col("s_range")), "left"
    )
    sampled = F.least(F.col("size"), F.greatest(F.lit(0), F.col("rest") - F.col("range_start") - F.col("inside")))
    return ordered.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + sampled).cast("bigint").alias("taken"),
        "draw_key",
    )


def op4(spark, sf_dir):
    from .common import table

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mix(spark, docs, sf_dir):
    """Pipeline stage (the last): the documents of the mix with the words taken of each."""
    taken = mix_sources(docs).where("taken > 0")
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5)
        / 4503599627370496.0)
    / (1.0 / (1.0 + 10.0 * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')))
        / greatest(length(coalesce(text, '')), 1))) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS ss,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w
      FROM d GROUP BY source),
r AS (SELECT *, 2.0 * ss AS cap, 2.0 * ss / w AS ratio FROM s),
l AS (SELECT *, (1.5 * sum(ss) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM r),
o AS (SELECT lvl AS water FROM l WHERE ratio >= lvl ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, CAST(ss AS BIGINT) AS source_size, least(cap, w * (SELECT water FROM o)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS ep FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.ep, CAST(floor(e.target - e.ep * e.source_size) AS BIGINT) AS rest,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  CAST(ep * size + least(size, greatest(0, rest - inside)) AS BIGINT) AS taken FROM p
"""
