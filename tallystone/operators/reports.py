"""Analyst queries and KPI measures over the views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystone.operators.lookup import attach
from tallystone.sources.tables import Staged


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview_view(view: DataFrame, keys: Sequence[str], rows: int = 10) -> DataFrame:
    return view.orderBy(*keys).limit(rows)


def top_vendors(vendor_monthly_view: DataFrame, n: int = 10) -> DataFrame:
    """Vendors with the highest spend; ties by name."""
    return (
        vendor_monthly_view.groupBy("vendor_name_clean")
        .agg(F.sum("total_spend").alias("spend"))
        .orderBy(F.desc("spend"), "vendor_name_clean")
        .limit(n)
    )


def top_risk_scores(risk_view: DataFrame, n: int = 10) -> DataFrame:
    return risk_view.orderBy(F.desc("risk_score"), "yyyymm", "vendor_name_clean").limit(n)


def top_risky_vendors(risk_view: DataFrame, n: int = 20) -> DataFrame:
    return risk_view.orderBy(F.desc("risk_score"), F.desc("outlier_txn"), "yyyymm", "vendor_name_clean").limit(n)


def latest_anomalies(anomaly_view: DataFrame, n: int = 50) -> DataFrame:
    """Newest transactions with any flag; ties by id."""
    flagged = F.col("is_outlier") | F.col("is_new_vendor") | F.col("is_high_amount")
    return anomaly_view.filter(flagged).orderBy(F.desc("transaction_date"), "transaction_id").limit(n)


def duplicate_months(dim_month: DataFrame) -> DataFrame:
    """Months that occur more than once in the month dimension; empty when it is sound."""
    return dim_month.groupBy("yyyymm").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")


def kpi_totals(exec_kpi: DataFrame) -> DataFrame:
    """Seven headline measures as one row.

    As defined for the dashboard: active vendors adds monthly counts, so a vendor counts once per
    month, and flagged adds both flags, so a doubly flagged transaction counts twice.
    """
    totals = exec_kpi.agg(
        F.sum("total_spend").alias("total_spend"),
        F.sum("txn_count").alias("total_txn"),
        F.sum("active_vendors").alias("active_vendors"),
        F.sum("outlier_txn").alias("outlier_txn"),
        F.sum("new_vendor_txn").alias("new_vendor_txn"),
    )
    return totals.select(
        "*",
        (F.col("outlier_txn") + F.col("new_vendor_txn")).alias("flagged_txn"),
        F.try_divide(F.col("total_spend").cast("double"), F.col("total_txn")).alias("avg_spend_per_txn"),
    )


def month_slice(view: DataFrame, dim_month: DataFrame, yyyymm: int | None = None) -> DataFrame:
    """A monthly view related to the month dimension, optionally cut to one month.

    The dimension has one row per calendar month, at most 119,988, so broadcasting it is safe.
    """
    attributes = dim_month.select("yyyymm", "year_month", "month_start")
    if yyyymm is not None:
        view = view.filter(F.col("yyyymm") == yyyymm)
    return view.join(F.broadcast(attributes), "yyyymm")


def date_slice(anomaly_view: DataFrame, dim_date: Staged, first: str | None = None, last: str | None = None) -> DataFrame:
    """Anomaly rows related to the date dimension, optionally cut to a span of days."""
    if first is not None:
        anomaly_view = anomaly_view.filter(F.col("transaction_date") >= F.lit(first).cast("date"))
    if last is not None:
        anomaly_view = anomaly_view.filter(F.col("transaction_date") <= F.lit(last).cast("date"))
    days = dim_date.select(
        F.col("date").alias("transaction_date"), "year_month", "dow_0_sun", "is_weekend", "month_start"
    )
    return attach(anomaly_view, days, "transaction_date", how="inner")


def calendar_slice(table: DataFrame, calendar: DataFrame, where: Column, days: bool = False) -> DataFrame:
    """Rows of a published table, stored in a folder per month, whose month (or day) the calendar's condition picks.

    The condition is on the calendar only. Its months are known before the table is scanned, so only their
    folders are read (dynamic partition pruning); with ``days`` rows are also matched by date. A calendar has
    at most 119,988 months, or 3.7 million days of three small columns, so it can be broadcast.
    """
    picked = calendar.filter(where)
    if not days:
        return table.join(F.broadcast(picked.select("yyyymm", "year_month")), "yyyymm")
    keys = picked.select("yyyymm", F.col("date").alias("transaction_date"), "dow_0_sun")
    return table.join(F.broadcast(keys), ["yyyymm", "transaction_date"])


def concentration(vendor_monthly_view: DataFrame, n: int = 10) -> DataFrame:
    """The vendors with the highest spend, their share of all spend and the share of all down to them."""
    per_vendor = vendor_monthly_view.groupBy("vendor_name_clean").agg(F.sum("total_spend").alias("spend"))
    total = per_vendor.agg(F.sum("spend").alias("total"))
    top = per_vendor.orderBy(F.desc("spend"), "vendor_name_clean").limit(n).crossJoin(F.broadcast(total))  # one row
    share = lambda x: (x.cast("double") / F.col("total").cast("double"))
    down_to = F.sum("spend").over(Window.orderBy(F.desc("spend"), "vendor_name_clean"))  # over n rows
    return top.select("vendor_name_clean", "spend", share(F.col("spend")).alias("share"), share(down_to).alias("cumulative_share"))
