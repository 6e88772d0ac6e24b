"""The table-writing jobs: landing, silver, gold, risk and the star reload.

Each reads what the previous one wrote, writes Parquet once and exports CSV from what it wrote.
Folder layout under the data folder: ``bronze/``, ``silver/``, ``gold/``, ``corp/``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallystone.operators import gold, integrity, quality, risk, serving
from tallystone.operators.silver import build_silver
from tallystone.plans.warehouse import STAR, Warehouse
from tallystone.sources.bronze import read_bronze, read_bronze_csv
from tallystone.sources.columns import gold_columns
from tallystone.sources.tables import export_csv, read_csv, read_table, stage, write_table
from tallystone.sources.versions import VersionFolder, current_tables, publish
from tallystone.streaming.arrivals import land_arrivals

FACT_PARTITIONS = {name: ["yyyymm"] for name in STAR.values() if not name.startswith("dim_")}
DIMENSIONS = ["dim_agency", "dim_vendor"]
# How tables are exported besides Parquet. Single files are for the small gold tables; others stay many files.
CSV_EXPORTS = ("none", "many", "single")


def _save(df: DataFrame, path: str, csv: str, small: bool = False) -> DataFrame:
    write_table(df, f"{path}.parquet")
    written = read_table(df.sparkSession, f"{path}.parquet")
    if csv != "none":
        export_csv(written, f"{path}_csv", single_file=csv == "single" and small)
    return written


def run_land(spark: SparkSession, drop: str, data: str) -> None:
    """CSV files that arrived in the drop folder since the last run to ``bronze``."""
    land_arrivals(spark, drop, f"{data}/bronze", f"{data}/bronze_arrivals").awaitTermination()


def run_silver(spark: SparkSession, bronze: str | None, data: str, csv: str = "many") -> DataFrame:
    """Bronze CSV files, or else the landed bronze table, to ``silver/spend_clean``."""
    rows = read_bronze_csv(spark, bronze) if bronze else read_bronze(spark, f"{data}/bronze")
    return _save(build_silver(rows), f"{data}/silver/spend_clean", csv)


def run_gold(spark: SparkSession, data: str, csv: str = "many") -> dict[str, DataFrame]:
    """Silver to the three gold tables."""
    cleaned = gold_columns(read_table(spark, f"{data}/silver/spend_clean.parquet"))
    monthly = _save(gold.vendor_monthly_spend(cleaned), f"{data}/gold/vendor_monthly_spend", csv, small=True)
    by_agency = _save(gold.agency_category_spend(cleaned), f"{data}/gold/agency_category_spend", csv, small=True)
    stats = stage(gold.category_stats(cleaned), "category-stats")
    first_seen = stage(gold.vendor_first_seen(monthly), "first-seen")
    anomaly = gold.transaction_anomaly(cleaned, stats, first_seen)
    return {
        "vendor_monthly_spend": monthly,
        "agency_category_spend": by_agency,
        "transaction_anomaly": _save(anomaly, f"{data}/gold/transaction_anomaly", csv),
    }


def run_risk(spark: SparkSession, data: str, csv: str = "many") -> DataFrame:
    """Gold anomalies to ``gold/vendor_risk_scores``."""
    anomaly = read_table(spark, f"{data}/gold/transaction_anomaly.parquet")
    return _save(risk.vendor_risk_all_time(anomaly), f"{data}/gold/vendor_risk_scores", csv, small=True)


# Exported table -> (folder, layer, types)
_SERVED = {
    "silver": ("silver/spend_clean", serving.STAGE_SILVER),
    "vendor_monthly": ("gold/vendor_monthly_spend", serving.STAGE_VENDOR_MONTHLY),
    "agency_category": ("gold/agency_category_spend", serving.STAGE_AGENCY_CATEGORY),
    "anomaly": ("gold/transaction_anomaly", serving.STAGE_ANOMALY),
}


def run_serving(spark: SparkSession, data: str, source: str = "parquet", keep_versions: int = 2) -> str:
    """Silver and gold to a new, checked version of the star under ``corp``; returns the version.

    ``source`` is ``parquet`` or ``csv``, the exported files. A value that does not fit its column's type
    stops the load. Dimensions grow by upsert from the published version, fact and marts are reloaded in
    full; ``keep_versions`` versions stay, older ones are removed.
    """
    layers = {}
    for layer, (folder, types) in _SERVED.items():
        written = read_table(spark, f"{data}/{folder}.parquet")
        layers[layer] = written if source == "parquet" else read_csv(spark, f"{data}/{folder}_csv", written.columns)
        serving.require_fitting(layers[layer], types, folder)
    published = current_tables(spark, f"{data}/corp", DIMENSIONS)
    warehouse = Warehouse.from_tables(published=published, **layers)
    return reload_star(spark, warehouse, f"{data}/corp", keep_versions)


STAMPS = {name: "ingested_at" if name.startswith("fact_") else "created_at" for name in STAR.values() if not name.startswith("dim_")}
METRICS = "load_metrics"


def reload_star(
    spark: SparkSession,
    warehouse: Warehouse,
    root: str,
    keep_versions: int = 2,
    limits: Sequence[quality.Limit] | None = None,
    least_share: float = 0.0,
) -> str:
    """Publish the warehouse's star as one version; its tables are written once, straight into the version's folder.

    The writes count rows, NULLs and value ranges as they go; the counts are held against ``limits`` and
    against ``least_share`` of the rows of the version before, and published as ``load_metrics``. NULLs are
    therefore not looked for again; keys and references are.
    """
    previous = current_tables(spark, root, [METRICS], missing_ok=True).get(METRICS)

    def check(folder: VersionFolder) -> None:
        metrics = folder.metrics
        own = quality.default_limits() if limits is None else list(limits)
        if previous is not None:
            own += quality.shrunk(metrics, previous, least_share)
        quality.check_quality(metrics, own)
        integrity.check_integrity(folder, nulls_checked=limits is None)
        folder.write(METRICS, quality.metric_rows(spark, metrics))

    try:
        return publish(spark, root, warehouse.write_star, check, FACT_PARTITIONS, keep_versions, STAMPS, quality.measures)
    except BaseException:
        warehouse.forget_star()
        raise


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["land", "silver", "gold", "risk", "serving", "all"])
    parser.add_argument("--data", required=True, help="folder for bronze/, silver/, gold/ and corp/")
    parser.add_argument("--drop", help="folder that CSV files are dropped into (land, and all if given)")
    parser.add_argument("--bronze", help="folder or glob of raw CSV files, instead of the landed table (silver and all)")
    parser.add_argument("--csv", choices=CSV_EXPORTS, default="many", help="CSV files per exported table")
    parser.add_argument("--serve-from", choices=["parquet", "csv"], default="parquet", help="what the star is loaded from")
    parser.add_argument("--keep-versions", type=int, default=2, help="published versions of the star to keep")
    args = parser.parse_args()
    if args.serve_from == "csv" and args.csv == "none" and args.job == "all":
        parser.error("--serve-from csv needs exported CSV files")
    if args.job == "land" and not args.drop:
        parser.error("--drop is required")

    spark = SparkSession.builder.appName(f"tallystone {args.job}").getOrCreate()
    if args.job == "land" or (args.job == "all" and args.drop):
        run_land(spark, args.drop, args.data)
    if args.job in ("silver", "all"):
        run_silver(spark, args.bronze, args.data, args.csv)
    if args.job in ("gold", "all"):
        run_gold(spark, args.data, args.csv)
    if args.job in ("risk", "all"):
        run_risk(spark, args.data, args.csv)
    if args.job in ("serving", "all"):
        print("published", run_serving(spark, args.data, args.serve_from, args.keep_versions))
    spark.stop()


if __name__ == "__main__":
    main()
