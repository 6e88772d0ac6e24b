"""Raw purchase transactions derived from the test tables.

The test tables hold no purchase-card file, so one is spelled out of ``lineitem`` and its
dimensions: every row becomes one messy text row (see FIXTURES.md, section 5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystone.functions import text
from tallystone.sources.tables import read_table


def spend_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven text columns, one row per line item.

    Plain equi-joins without hints: file sizes tell Catalyst which sides are small enough to
    broadcast, the others are sort-merge joined and a hot key is split by AQE's skew join. The order is joined
    last of the large tables, so rows of one order lie together; names of supplier and nation come after it, as
    nothing is shuffled for them, prices go in whole cents, whose binary form is short, and a part's texts go as one.
    """

    def table(name, *columns):
        return read_table(spark, f"{sf_dir}/{name}.parquet").select(*columns)

    buyers = table("customer", "c_custkey", "c_nationkey")
    orders = table("orders", "o_orderkey", "o_custkey").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    cents = F.round(F.col("l_extendedprice") * 100).alias("cents")
    texts = ["p_brand", "p_name"]
    part = table("part", "p_partkey", *texts)
    part = part.select("p_partkey", (F.col("p_partkey") % 9).alias("kind"), text.pack(texts).alias("texts"))
    lines = (
        table("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents, "l_shipdate")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("supplier", "s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation", "n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .transform(text.unpack, "texts", texts)
    )

    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    vendor = F.concat_ws(" ", "s_name", "p_brand")
    categories = [
        "AIRLINES", "Computer Software", "OFFICE SUPPLIES", "Restaurants", "FURNITURE",
        "Greeting Cards", "Charity", "Books", None,
    ]
    shipped = F.col("l_shipdate").cast("string")
    day, clock = F.substring(shipped, 1, 10), F.substring(shipped, 12, 8)
    year, month, day_of_month = F.substring(day, 1, 4), F.substring(day, 6, 2), F.substring(day, 9, 2)
    spelled_dates = [
        F.concat(F.translate(day, "-", "/"), F.lit(" "), clock, F.lit("+00")),
        F.concat(day, F.lit("T"), clock, F.lit("Z")),
        F.concat_ws("/", month, day_of_month, year),
        day,
        F.translate(day, "-", "/"),
    ]

    cents = F.call_function("div", F.col("cents").cast("bigint"), F.lit(40))
    cents = cents * F.when(order % 499 == 0, 30).otherwise(1)
    dollars = F.concat(
        F.format_number(F.call_function("div", cents, F.lit(100)), 0),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    return lines.select(
        (order * 10 + line).cast("string").alias("transaction_id"),
        F.when(line % 2 == 0, F.concat("n_name", F.lit("  "))).otherwise(F.col("n_name")).alias("agency_name"),
        F.when(line % 3 == 0, F.lower(vendor))
        .when(line % 3 == 1, F.concat(F.lit("  "), vendor, F.lit(" ")))
        .otherwise(vendor)
        .alias("vendor_name"),
        _pick(F.col("kind"), [F.lit(c) for c in categories]).alias("mcc_description"),
        F.when(order % 227 == 0, "n/a").otherwise(_pick(line % 5, spelled_dates)).alias("transaction_date"),
        F.when(order % 211 == 0, F.concat(F.lit("($"), dollars, F.lit(")")))
        .when(order % 223 == 0, F.concat(F.lit("-"), dollars))
        .otherwise(F.concat(F.lit("$"), dollars))
        .alias("amount"),
        F.col("p_name").alias("description"),
    )


def _pick(index, choices):
    picked = F
    for i, choice in enumerate(choices):
        picked = picked.when(index == i, choice)
    return picked.otherwise(None)
