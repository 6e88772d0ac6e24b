"""Times the headline layers and prints one JSON line.

The test tables hold no purchase file, so raw rows are spelled out of other tables first. That adapter is
timed as a line of its own; every layer then starts from the raw table it wrote, and does all its work
again, intermediate tables included. ``yardstick`` holds plain Spark spellings of two layers, run in
between over the same raw table, so that a slow machine shows in both.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallystone.operators import gold, reports, silver
from tallystone.plans.warehouse import Warehouse
from tallystone.sources.columns import gold_columns
from tallystone.sources.fixture import spend_bronze
from tallystone.sources.tables import release_staged, stage


def _cleaned(raw: DataFrame) -> DataFrame:
    return gold_columns(silver.build_silver(raw))


HEADLINE = {
    "build_silver": lambda raw: silver.build_silver(raw),
    "vendor_monthly_spend": lambda raw: gold.vendor_monthly_spend(_cleaned(raw)),
    "agency_category_spend": lambda raw: gold.agency_category_spend(_cleaned(raw)),
    "category_stats": lambda raw: gold.category_stats(_cleaned(raw)),
    "transaction_anomaly": lambda raw: Warehouse(raw).anomaly,
    "vendor_risk_all_time": lambda raw: Warehouse(raw).vendor_risk,
    "load_fact": lambda raw: Warehouse(raw).fact,
    "vendor_risk_monthly": lambda raw: Warehouse(raw).mart_vendor_risk,
    "v_exec_kpi": lambda raw: Warehouse(raw).v_exec_kpi,
    "top_vendors": lambda raw: reports.top_vendors(Warehouse(raw).v_vendor_monthly_spend),
}


def _plain_silver(raw: DataFrame) -> DataFrame:
    """The newest row per id by a window, as one would write it at first."""
    rows = silver.filter_valid(silver.type_money_and_time(silver.project_raw(raw)))
    newest = Window.partitionBy("transaction_id").orderBy(F.desc("transaction_ts"), F.desc("amount"))
    return silver.enrich(rows.withColumn("_n", F.row_number().over(newest)).filter("_n = 1"))


YARDSTICK = {
    "plain_silver": _plain_silver,
    "plain_vendor_monthly": lambda raw: _plain_silver(raw)
    .groupBy("year", "month", "vendor_name_clean")
    .agg(F.count(F.lit(1)), F.sum("amount"), F.avg("amount")),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallystone bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    adapter = [timed(lambda: spend_bronze(spark, sf_dir)) for _ in range(repeats)]
    raw = stage(spend_bronze(spark, sf_dir), "raw").df
    timed(lambda: HEADLINE["v_exec_kpi"](raw))  # warm-up
    runs: dict[str, list[float]] = {}
    for _ in range(repeats):
        for name, build in (HEADLINE | YARDSTICK).items():
            runs.setdefault(name, []).append(timed(lambda b=build: b(raw)))
    medians = {name: round(statistics.median(seconds), 3) for name, seconds in runs.items()}
    seconds = {name: medians[name] for name in HEADLINE}
    release_staged(spark)
    spark.stop()
    result = {
        "metric": "headline layers over a written raw table, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "adapter": round(statistics.median(adapter), 3),
        "yardstick": {name: medians[name] for name in YARDSTICK},
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
        "repeats": repeats,
    }
    print(json.dumps(result))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
