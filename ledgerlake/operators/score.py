"""KPI percentages and the hybrid system risk score.

Percentages need eight counts (all fact rows and seven indicator tables).
They are combined without a join: each count is a one-row aggregate, the
rows are unioned into (name, n) pairs and folded into one row by a single
aggregate. The four row-level indicators are counted in one pass over the
fact with ``count_if``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..functions.flags import risk_level
from . import kpis

KPI_NAMES = ("k1", "k2", "k3", "k4", "k5", "k6", "k7")


def _fold_counts(parts: list[DataFrame], names: list[str]) -> DataFrame:
    long = reduce(DataFrame.unionByName, parts)
    return long.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


def kpi_counts_from_tables(fact: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """One row (total_txns, k1..k7) from the fact and seven indicator tables."""
    if len(tables) != len(KPI_NAMES):
        raise ValueError("expected seven indicator tables")
    parts = [fact.agg(F.lit("total_txns").alias("name"), F.count(F.lit(1)).alias("n"))]
    parts += [tb.agg(F.lit(k).alias("name"), F.count(F.lit(1)).alias("n")) for k, tb in zip(KPI_NAMES, tables)]
    return _fold_counts(parts, ["total_txns", *KPI_NAMES])


def kpi_counts(fact: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Same row as :func:`kpi_counts_from_tables`, with k1, k4, k5, k7 (row
    filters of the fact) counted in one scan."""
    row_level = fact.agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.count_if(kpis.new_beneficiary_high_amount_condition()).alias("k1"),
        F.count_if(kpis.current_overactivity_condition(t)).alias("k4"),
        F.count_if(kpis.kyc_pending_condition(t)).alias("k7"),
    )
    parts = [
        row_level.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("name"), F.col(c).alias("n"))
            for n, c in (("total_txns", "total_txns"), ("k1", "k1"), ("k4", "k4"), ("k5", "k1"), ("k7", "k7"))
        ])).alias("p")).select("p.name", "p.n"),
        kpis.kpi_rapid_distribution(fact, t).agg(F.lit("k2").alias("name"), F.count(F.lit(1)).alias("n")),
        kpis.kpi_savings_abnormal(fact, t).agg(F.lit("k3").alias("name"), F.count(F.lit(1)).alias("n")),
        kpis.kpi_impossible_travel(fact, t).agg(F.lit("k6").alias("name"), F.count(F.lit(1)).alias("n")),
    ]
    return _fold_counts(parts, ["total_txns", *KPI_NAMES])


def kpi_percentages_from_counts(counts: DataFrame) -> DataFrame:
    """p_i = k_i / total (NULL when there are no transactions)."""
    return counts.select(
        *[F.try_divide(F.col(k), F.col("total_txns")).alias(f"p{i + 1}") for i, k in enumerate(KPI_NAMES)]
    )


def kpi_percentages(fact: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    return kpi_percentages_from_counts(kpi_counts(fact, t))


def system_risk_score(percentages: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Hybrid score: h_i = a * w_i + b * p_i / sum(p); score = sum(p_i * h_i);
    bands HIGH / MEDIUM / LOW (NULL score -> LOW)."""
    p = [F.col(f"p{i}") for i in range(1, 8)]
    total = reduce(lambda a, b: a + b, p)
    df = percentages.withColumn("total_pct", total)
    score = None
    for i, (pi, w) in enumerate(zip(p, t.static_weights)):
        d = F.try_divide(pi, F.col("total_pct"))
        h = F.lit(t.static_share) * F.lit(w) + F.lit(t.dynamic_share) * d
        term = pi * h
        score = term if score is None else score + term
    df = df.withColumn("risk_score", score)
    return df.select("risk_score", risk_level(F.col("risk_score"), t).alias("risk_level"))
