"""Row-level classification expressions (all Catalyst, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds


def normalised_amount(amount: Column, currency: Column, t: Thresholds = DEFAULT) -> Column:
    """Amount in INR by fixed rates; unknown currency -> NULL."""
    expr = None
    for cur, rate in t.currency_rates:
        value = amount if rate == 1 else amount * F.lit(rate)
        expr = F.when(currency == cur, value) if expr is None else expr.when(currency == cur, value)
    return expr.cast("decimal(22,2)")


def account_match_flag(txn_type: Column, account_id: Column, from_account: Column) -> Column:
    return (
        F.when(txn_type.isin("DEPOSIT", "CREDIT"), F.lit("Not_Applicable"))
        .when(account_id == from_account, F.lit("SAME_ACCOUNT"))
        .otherwise(F.lit("SUSPICIOUS"))
    )


def validation_flag(txn_type: Column, from_account: Column, to_account: Column, merchant_id: Column) -> Column:
    valid = (
        ((txn_type == "WITHDRAWAL") & from_account.isNotNull() & to_account.isNull())
        | ((txn_type == "TRANSFER") & from_account.isNotNull() & to_account.isNotNull())
        | ((txn_type == "DEBIT") & from_account.isNotNull() & merchant_id.isNotNull() & to_account.isNull())
        | (txn_type.isin("CREDIT", "DEPOSIT") & to_account.isNotNull() & from_account.isNull())
    )
    return F.when(valid, F.lit("VALID")).otherwise(F.lit("INVALID"))


def as_flag(cond: Column) -> Column:
    """Boolean -> 1/0 (NULL -> 0, like ``when(...).otherwise(0)``)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def channel_limit_flag(channel: Column, daily_total: Column, t: Thresholds = DEFAULT) -> Column:
    cond = None
    for ch, limit in t.channel_limits:
        c = (channel == ch) & (daily_total > limit)
        cond = c if cond is None else cond | c
    return as_flag(cond)


def risk_level(score: Column, t: Thresholds = DEFAULT) -> Column:
    """NULL score (nothing flagged) falls to LOW, as the ``otherwise`` does."""
    return (
        F.when(score >= t.high_risk, F.lit("HIGH"))
        .when(score >= t.medium_risk, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )
