"""Gold: monthly spend, category statistics, first-seen months and anomaly flags.

Every operator takes a table that ``sources.columns.gold_columns`` has brought to common names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystone.functions import flags, money, rules, text
from tallystone.functions.dates import first_of_month
from tallystone.operators.lookup import attach
from tallystone.sources.tables import Staged


# The vendor's id, where rows got it together with the first month: serving needs no join of its own then.
MATCHED = "_vendor_id"
# The share of a month's vendors that a row was dealt to, where rows lie together by month and share already.
SHARE = "_share"
# What a vendor's month sums to, in one of its rows (see ``with_month_sums``).
SUMS = "_sums"


def spend_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, total and average amount per key.

    Amounts are added as decimals, so the result does not depend on the order of addition; the
    total and its quotient are doubles.
    """
    return df.groupBy(*keys).agg(*_spend(F.count(F.lit(1)), F.sum("amount"), F.count("amount")))


def _spend(rows: Column, total: Column, amounts: Column) -> list[Column]:
    total = total.cast("double")
    return [rows.alias("txn_count"), total.alias("total_spend"), F.try_divide(total, amounts).alias("avg_spend")]


def with_month_sums(df: DataFrame, stats: Staged, within: Sequence[str], sigmas: float = rules.OUTLIER_SIGMAS) -> DataFrame:
    """Rows with ``SUMS``: what their vendor's month sums to, in one row of each vendor and month, NULL in the others.

    ``df`` has the columns of ``gold_columns`` with each vendor's first month, and lies together by ``within``, the month
    among it, so that nothing is moved. A total that is the row's own amount is left out. Flags are counted over the
    rows that the anomaly mart keeps: those whose vendor and agency have names.
    """
    month = Window.partitionBy(*within, "vendor_name").orderBy("vendor_name")
    whole = month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    outlier = flags.is_outlier(money.amount_num(F.col("amount")), F.col("mean_amount"), F.col("std_amount"), sigmas) == 1
    new_vendor = flags.is_new_vendor_month(txn_month(), F.col("first_seen_month")) == 1
    known = ~text.is_blank(F.col("vendor_name")) & ~text.is_blank(F.col("agency_name"))
    rows = F.count(F.lit(1)).over(whole)
    sums = F.struct(
        rows.alias("rows"),
        F.count("amount").over(whole).alias("amounts"),
        F.when(rows > 1, F.sum("amount").over(whole)).alias("total"),
        F.count_if(known).over(whole).alias("known"),
        F.count_if(known & outlier).over(whole).alias("outlier_txn"),
        F.count_if(known & new_vendor).over(whole).alias("new_vendor_txn"),
    )
    joined = join_category_stats(df, stats)
    return joined.select(*df.columns, F.when(F.row_number().over(month) == 1, sums).alias(SUMS))


def vendor_monthly_spend(df: DataFrame) -> DataFrame:
    """Rows that carry their vendor's id (``MATCHED``) keep it, and those dealt to shares (``SHARE``) are not moved again.

    Of rows with their months' ``SUMS`` nothing is left to add.
    """
    if SUMS in df.columns:
        sums = F.col(SUMS)
        total = F.when(sums["rows"] == 1, F.col("amount")).otherwise(sums["total"])
        spent = df.filter(sums.isNotNull())
        return spent.select("year", "month", "vendor_name", MATCHED, *_spend(sums["rows"], total, sums["amounts"]))
    return spend_summary(df, ["year", "month", "vendor_name", *[name for name in df.columns if name in (MATCHED, SHARE)]])


def agency_category_spend(df: DataFrame) -> DataFrame:
    return spend_summary(df, ["year", "month", "agency_name", "category_group"])


def sort_by_spend(df: DataFrame) -> DataFrame:
    """Largest total first, keys as tie-break. For reading; written tables are left unsorted."""
    keys = [name for name in df.columns if name not in ("txn_count", "total_spend", "avg_spend")]
    return df.orderBy(F.col("total_spend").desc_nulls_last(), *keys)


def category_stats(df: DataFrame) -> DataFrame:
    """Mean and population standard deviation of the amount per merchant category."""
    amount = money.amount_num(F.col("amount"))
    return df.groupBy("merchant_category").agg(
        F.try_divide(F.sum("amount").cast("double"), F.count("amount")).alias("mean_amount"),
        F.stddev_pop(amount).alias("std_amount"),
    )


def vendor_first_seen(df: DataFrame, counted: bool = False) -> DataFrame:
    """First month per vendor. Also works on ``vendor_monthly_spend``, which is far smaller.

    ``counted`` adds ``n``, the vendor's transactions.
    """
    rows = F.sum("txn_count") if "txn_count" in df.columns else F.count(F.lit(1))
    found = [F.min(txn_month()).alias("first_seen_month"), *([rows.alias("n")] if counted else [])]
    return df.groupBy("vendor_name").agg(*found)


def txn_month() -> Column:
    return first_of_month(F.col("year"), F.col("month"))


def join_category_stats(df: DataFrame, stats: Staged, **sizing) -> DataFrame:
    """Left join on the merchant category. Few, huge categories: no shuffle on that key (see ``attach``)."""
    return attach(df, stats, "merchant_category", **sizing)


def join_first_seen(df: DataFrame, first_seen: Staged, **sizing) -> DataFrame:
    """Left join on the vendor; rows that carry their vendor's first month already keep it."""
    if "first_seen_month" in df.columns:
        return df
    return attach(df, first_seen, "vendor_name", **sizing)


def transaction_anomaly(
    df: DataFrame, stats: Staged, first_seen: Staged, sigmas: float = rules.OUTLIER_SIGMAS, **sizing
) -> DataFrame:
    """Every transaction with its category's statistics and both flags, 13 columns (and ``MATCHED``, if it is there).

    The statistics are aggregated first and joined back; a window over each category would put
    most of the data on a few tasks.
    """
    joined = df.transform(join_first_seen, first_seen, **sizing).transform(join_category_stats, stats, **sizing)
    matched = [name for name in joined.columns if name == MATCHED]
    amount = money.amount_num(F.col("amount"))
    return joined.select(
        "transaction_id",
        "transaction_date",
        "agency_name",
        "vendor_name",
        "merchant_category",
        "category_group",
        "amount",
        "mean_amount",
        "std_amount",
        flags.is_outlier(amount, F.col("mean_amount"), F.col("std_amount"), sigmas).alias("is_outlier"),
        flags.is_new_vendor_month(txn_month(), F.col("first_seen_month")).alias("is_new_vendor_month"),
        "year",
        "month",
        *matched,
    )
