"""Anomaly flags and risk points."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallystone.functions import rules


def is_outlier(amount: Column, mean: Column, std: Column, sigmas: float = rules.OUTLIER_SIGMAS) -> Column:
    """1 when the amount lies strictly above ``mean + sigmas * std``; 0 also when there is no std."""
    return F.coalesce((amount > mean + std * sigmas).cast("int"), F.lit(0))


def is_new_vendor_month(month_start: Column, first_seen: Column) -> Column:
    """1 for every transaction in the vendor's first month."""
    return F.coalesce((month_start == first_seen).cast("int"), F.lit(0))


def is_high_amount(amount: Column, limit: float = rules.HIGH_AMOUNT) -> Column:
    return amount >= limit


def anomaly_reason(outlier: Column, new_vendor: Column, high_amount: Column) -> Column:
    """Strongest reason of a flagged transaction, NULL when nothing is flagged."""
    return (
        F.when(outlier & new_vendor, "OUTLIER+NEW_VENDOR")
        .when(outlier, "OUTLIER")
        .when(high_amount, "HIGH_AMOUNT")
        .when(new_vendor, "NEW_VENDOR")
    )


def monthly_risk_score(
    outlier_txn: Column,
    new_vendor_txn: Column,
    outlier_points: int = rules.OUTLIER_POINTS,
    new_vendor_points: int = rules.NEW_VENDOR_POINTS,
) -> Column:
    """Points for a vendor's month: 0, 30, 70 or 100 under the default points."""
    return (outlier_txn > 0).cast("int") * outlier_points + (new_vendor_txn > 0).cast("int") * new_vendor_points


def risk_score_raw(
    has_outlier: Column,
    is_new: Column,
    spend_rank: Column,
    outlier_rate: Column,
    outlier_points: int = rules.OUTLIER_POINTS,
    new_vendor_points: int = rules.NEW_VENDOR_POINTS,
    rank_points: int = rules.SPEND_RANK_POINTS,
    rate_points: int = rules.OUTLIER_RATE_POINTS,
) -> Column:
    """All-time points of a vendor before the cap. Every vendor has a first month, so ``is_new`` is always 1."""
    return (
        has_outlier * outlier_points
        + is_new * new_vendor_points
        + spend_rank * rank_points
        + outlier_rate * rate_points
    )


def risk_score(raw: Column, cap: float = rules.MAX_RISK) -> Column:
    return F.least(F.lit(float(cap)), raw)
