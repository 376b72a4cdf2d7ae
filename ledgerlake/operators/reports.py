"""Regulator reports over the transaction fact (two-phase aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_daily(fact: DataFrame) -> DataFrame:
    """Count and total per (txn_date, channel)."""
    return fact.groupBy("txn_date", "channel").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount")
    )


def report_monthly(fact: DataFrame) -> DataFrame:
    """Count and total per (yyyy-MM, channel)."""
    return (
        fact.withColumn("txn_month", F.date_format("txn_date", "yyyy-MM"))
        .groupBy("txn_month", "channel")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount"))
    )


def report_daily_pivot(daily: DataFrame) -> DataFrame:
    """txn_date x channel -> sum of amounts, with a column for every channel in
    the data. ``daily`` is the :func:`report_daily` table: one row per day and
    channel, so finding the channels does not read the fact again."""
    return daily.groupBy("txn_date").pivot("channel").agg(F.sum("total_amount").cast("decimal(28,2)"))
