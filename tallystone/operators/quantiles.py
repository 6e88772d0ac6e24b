"""Outliers by percentiles of each category: exact bounds by counting in ranges, or bounds from mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystone.operators.lookup import attach
from tallystone.sources.tables import stage

SHARES = (0.95, 0.99)
# Ranges that one round tells apart: 2 ** RANGE_BITS for every key.
RANGE_BITS = 10
# Size of a sketch; ranks are off by about 0.3 % of a category's rows, 1 % at the very most in practice.
SKETCH_K = 1024


def _name(share: float) -> str:
    return f"p{share * 100:g}".replace(".", "_")


def exact_bounds(df: DataFrame, key: str, value: str, shares: Sequence[float] = SHARES, range_bits: int = RANGE_BITS) -> DataFrame:
    """``key, p95, p99, ...`` for every key that is not NULL: the smallest value that so large a share does not exceed.

    ``value`` is a bigint; NULL values do not count. Equal values of a key are counted first, combined
    before the shuffle. Then each round counts the values of a key in equal ranges and goes on in the range
    that holds the wanted rank, so no task ever sorts a key's values, however many there are.
    """
    values = df.select(F.col(key).alias("key"), F.col(value).cast("bigint").alias("value")).dropna()
    counted = stage(values.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts").df
    least = F.min("value").alias("least")
    keys = stage(counted.groupBy("key").agg(least, F.max("value").alias("most"), F.sum("n").alias("rows")), "key-ranges", measured=True)
    widest = keys.df.agg(F.max(F.col("most") - F.col("least"))).first()[0] or 0
    bits = max(1, ceil(widest.bit_length() / range_bits)) * range_bits
    shifted = attach(counted, keys.select("key", "least"), "key", how="inner").select("key", (F.col("value") - F.col("least")).alias("value"), "n")
    # A row per key and share: the rank looked for among the values with the prefix found so far.
    rank = lambda share: F.greatest(F.ceil(F.col("rows") * F.lit(share) - 1e-9), F.lit(1)).cast("bigint")
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("share"), rank(s).alias("rank")) for i, s in enumerate(shares)]))
    state = keys.df.select("key", wanted.alias("w"), F.lit(0).cast("bigint").alias("prefix")).select("key", "w.*", "prefix")
    for shift in range(bits - range_bits, -1, -range_bits):
        state = stage(state, "ranks", measured=True)
        # Up to a round's ranges per key: the shares' prefixes, as one lookup row per key.
        prefixes = stage(state.df.groupBy("key").agg(F.collect_set("prefix").alias("prefixes")), "prefixes", measured=True)
        at = F.shiftright("value", shift + range_bits)
        open_ranges = attach(shifted, prefixes, "key", how="inner").filter(F.array_contains("prefixes", at))
        ranges = open_ranges.groupBy("key", F.shiftright("value", shift).alias("range")).agg(F.sum("n").alias("n"))
        met = ranges.join(state.df, "key").filter(F.shiftright("range", range_bits) == F.col("prefix"))
        through = F.sum("n").over(Window.partitionBy("key", "share").orderBy("range"))  # at most 2 ** range_bits rows
        reached = met.withColumn("through", through).filter((F.col("through") >= F.col("rank")) & (F.col("through") - F.col("n") < F.col("rank")))
        state = reached.select("key", "share", (F.col("rank") - F.col("through") + F.col("n")).alias("rank"), F.col("range").alias("prefix"))
    found = stage(state, "ranks").df.groupBy("key").agg(*[F.max(F.when(F.col("share") == i, F.col("prefix"))).alias(_name(s)) for i, s in enumerate(shares)])
    bounds = found.join(keys.df.select("key", "least"), "key")
    return bounds.select(F.col("key").alias(key), *[(F.col(_name(s)) + F.col("least")).alias(_name(s)) for s in shares])


def value_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """``keys, sketch``: one quantile sketch of bounded size per group; sketches of parts can be merged later."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"))


def sketched_bounds(sketches: DataFrame, key: str, shares: Sequence[float] = SHARES) -> DataFrame:
    """The bounds of ``exact_bounds`` with an error in rank, from sketches of any parts of the keys' rows."""
    merged = sketches.filter(F.col(key).isNotNull()).groupBy(key).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return merged.select(key, *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(s)).alias(_name(s)) for s in shares])


def cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def percentile_outliers(df: DataFrame, bounds: DataFrame, shares: Sequence[float] = SHARES, key: str = "merchant_category") -> DataFrame:
    """Transactions with their category's bounds (in money) and whether they exceed them.

    Few, huge categories: bounds are attached, rows are not shuffled on the category. Without a category
    there is no bound and no flag.
    """
    names = [_name(s) for s in shares]
    joined = attach(df, stage(bounds.select(key, *names), "bounds", measured=True), key)
    above = {f"above_{n}": F.coalesce((cents(F.col("amount")) > F.col(n)).cast("int"), F.lit(0)) for n in names}
    money = {n: (F.col(n).cast("decimal(18,0)") / 100).cast("decimal(18,2)") for n in names}
    return joined.withColumns(above).withColumns(money).select("transaction_id", key, "amount", *names, *above)
