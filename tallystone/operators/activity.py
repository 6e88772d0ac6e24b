"""Distinct vendors over any span of months, from one bitmap of vendor ids per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def vendor_activity(vendor_monthly: DataFrame) -> DataFrame:
    """``yyyymm, bucket, vendors``: which vendors were active in a month, as bits.

    Ids are dense, so a bucket of 32,768 of them is a bitmap of 4 KB. Exact, and far smaller than
    the monthly mart: a month takes as many rows as there are buckets.
    """
    placed = vendor_monthly.select("yyyymm", F.bitmap_bucket_number("vendor_id").alias("bucket"), F.bitmap_bit_position("vendor_id").alias("bit"))
    return placed.groupBy("yyyymm", "bucket").agg(F.bitmap_construct_agg("bit").alias("vendors"))


def active_vendors(activity: DataFrame, **span: Column) -> DataFrame:
    """Distinct vendors per span; a span is made of expressions over ``yyyymm``, by name. Neither fact nor mart is read."""
    spans = activity.select(*[value.alias(name) for name, value in span.items()], "bucket", "vendors")
    united = spans.groupBy(*span, "bucket").agg(F.bitmap_or_agg("vendors").alias("vendors"))
    return united.groupBy(*span).agg(F.sum(F.bitmap_count("vendors")).alias("active_vendors"))


def year(yyyymm: str = "yyyymm") -> Column:
    return F.floor(F.col(yyyymm) / 100).cast("int")


def quarter(yyyymm: str = "yyyymm") -> Column:
    return F.ceil(F.col(yyyymm) % 100 / 3).cast("int")
