"""BI views over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystone.operators.lookup import attach
from tallystone.sources.tables import Staged


def v_vendor_monthly_spend(vendor_monthly: DataFrame) -> DataFrame:
    return vendor_monthly.select(
        "yyyymm", "year", "month", "vendor_name_clean", "txn_count", "total_spend", "avg_spend"
    )


def v_agency_category_spend(agency_category: DataFrame) -> DataFrame:
    return agency_category.select(
        "yyyymm", "year", "month", "agency_name", "category_group", "txn_count", "total_spend", "avg_spend"
    )


def v_transaction_anomaly(anomaly: DataFrame, dim_agency: Staged, dim_vendor: Staged) -> DataFrame:
    """Anomaly rows with names instead of ids; names that the rows carry already are not looked up."""
    named = anomaly
    if "vendor_name_clean" not in named.columns:
        named = attach(named, dim_vendor.select("vendor_id", "vendor_name_clean"), "vendor_id", how="inner")
    if "agency_name" not in named.columns:
        named = attach(named, dim_agency.select("agency_id", "agency_name"), "agency_id", how="inner")
    return named.select(
        "yyyymm", "transaction_id", "transaction_date", "agency_name", "vendor_name_clean", "category_group",
        "amount", "is_outlier", "is_new_vendor", "is_high_amount", "anomaly_reason",
    )


def v_vendor_risk_scores(vendor_risk: DataFrame) -> DataFrame:
    return vendor_risk.select("yyyymm", "vendor_name_clean", "outlier_txn", "new_vendor_txn", "risk_score")


def v_dim_date(fact: DataFrame) -> DataFrame:
    """One row per day from the fact's first to its last; none for an empty fact.

    Weekdays are numbered from 0 = Sunday, unlike the fact's. Month names are blank-padded to nine.
    """
    bounds = fact.agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    date = F.col("date")
    return bounds.select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("date")).select(
        date,
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        (F.year(date) * 100 + F.month(date)).alias("yyyymm"),
        F.dayofmonth(date).alias("day"),
        (F.dayofweek(date) - 1).alias("dow_0_sun"),
        F.dayofweek(date).isin(1, 7).alias("is_weekend"),
        F.date_format(date, "MMM").alias("month_short"),
        F.rpad(F.date_format(date, "MMMM"), 9, " ").alias("month_name"),
        F.date_format(date, "yyyy-MM").alias("year_month"),
        F.trunc(date, "month").alias("month_start"),
    )


def v_dim_month(dim_date: DataFrame) -> DataFrame:
    """One row per month; the "one" side of monthly relations."""
    attributes = ["year", "month", "year_month", "month_name", "month_short", "month_start"]
    return dim_date.groupBy("yyyymm").agg(*[F.min(name).alias(name) for name in attributes])


def v_exec_kpi(vendor_monthly_view: DataFrame, anomaly: DataFrame) -> DataFrame:
    """Spend, transactions, active vendors and flag counts per month, in month order.

    Only month and flags of the anomalies are counted, so the mart serves as well as its view: every
    id of a published mart resolves, and its names are not needed.
    """
    spend = vendor_monthly_view.groupBy("yyyymm", "year", "month").agg(
        F.sum("total_spend").alias("total_spend"),
        F.sum("txn_count").alias("txn_count"),
        F.count_distinct("vendor_name_clean").alias("active_vendors"),
    )
    flagged = anomaly.groupBy("yyyymm").agg(
        F.count_if("is_outlier").alias("outlier_txn"), F.count_if("is_new_vendor").alias("new_vendor_txn")
    )
    # One row per calendar month of years 1 to 9999: never more than 119,988 small rows to broadcast.
    return spend.join(F.broadcast(flagged), "yyyymm", "left").fillna(0, ["outlier_txn", "new_vendor_txn"]).orderBy("yyyymm")
