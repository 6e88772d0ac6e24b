"""Global ranks and dense ids without a single-task window over the data."""

from __future__ import annotations

from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystone.operators.lookup import attach
from tallystone.sources.tables import stage

# What one window task is given to sort.
ROWS_PER_RANGE = 200_000


def percent_rank(df: DataFrame, value: str, name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``percent_rank() over (order by value)`` as a distributed computation; NULLs rank first, NaN last.

    The rank is (rows strictly below) / (rows - 1). Distinct values are counted first and accumulated in
    their order, range by range.
    """
    counted = stage(df.groupBy(value).agg(F.count(F.lit(1)).alias("n")), "rank-values").df
    rows = counted.agg(F.sum("n")).first()[0] or 0
    below = _running(counted, [F.col(value).asc_nulls_first()], F.col("n"), "below", rows_per_range)
    ranks = below.select(value, (F.col("below") / F.lit(max(rows - 1, 1))).alias(name))
    known = ranks.filter(F.col(value).isNotNull())
    # One value may be shared by a large part of the rows, hence not a plain join back. No row is below a NULL.
    ranked = attach(df, stage(known, "ranks"), value)
    return ranked.withColumn(name, F.coalesce(name, F.lit(0.0)))


def dense_ids(keys: DataFrame, key: str, name: str, start: int = 0, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Number unique keys ``start + 1, start + 2, ...`` in key order. ``keys`` is read twice: pass a written table."""
    numbered = row_numbers(keys, [F.col(key)], name, rows_per_range)
    return numbered.withColumn(name, F.col(name) + F.lit(start).cast("bigint"))


def row_numbers(df: DataFrame, order: list[Column], name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``row_number() over (order by ...)`` (bigint, from 1) without putting all rows in one task.

    ``df`` is read twice: pass a written table.
    """
    before = _running(df, order, F.lit(1).cast("bigint"), name, rows_per_range)
    return before.withColumn(name, F.col(name) + 1)


def _running(df: DataFrame, order: list[Column], size: Column, name: str, rows_per_range: int) -> DataFrame:
    """Add the total size of all rows before each row in the given order, which must be unique.

    Up to ``rows_per_range`` rows are summed in one task. More are written in ranges of the order, each
    row with its range's number, so that the numbers stay what they are; of the ranges, as many as the
    rows need, only the total sizes come to the driver.
    """
    ranges = max(1, ceil(df.count() / rows_per_range))
    ranged = df.withColumn("_range", F.lit(0))
    offsets = [0]
    if ranges > 1:
        ranged = stage(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges").df
        sizes = {r["_range"]: r["size"] for r in ranged.groupBy("_range").agg(F.sum(size).alias("size")).collect()}
        offsets = list(accumulate((sizes.get(i, 0) for i in range(ranges - 1)), initial=0))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.element_at(F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>"), F.col("_range") + 1)
    return ranged.withColumn(name, F.coalesce(F.sum(size).over(within), F.lit(0).cast("bigint")) + offset).drop("_range")
