"""Loading some months into a published star: what other months hold keeps its files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystone.operators import gold, serving
from tallystone.operators.lookup import fits_broadcast
from tallystone.plans.jobs import FACT_PARTITIONS, STAMPS
from tallystone.plans.warehouse import STAR
from tallystone.sources.columns import gold_columns
from tallystone.sources.tables import Staged, remove_folder, stage
from tallystone.sources.versions import current_folder, current_tables

_MONTH = "yyyymm"


def _replace_months(spark: SparkSession, folder: str, table: str, rows: DataFrame, months: Sequence[int]) -> None:
    """Put ``rows`` in place of everything that the table holds for ``months``."""
    rows = stage(rows.filter(F.col(_MONTH).isin(list(months))), f"months-{table}").df
    filled = {r[0] for r in rows.select(_MONTH).distinct().collect()}
    if filled:
        stamped = serving.audit_column(rows, STAMPS[table]).hint("rebalance", F.col(_MONTH))
        stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_MONTH).parquet(f"{folder}/{table}")
    for month in set(months) - filled:
        remove_folder(spark, f"{folder}/{table}/{_MONTH}={month}")


def _grown(spark: SparkSession, folder: str, name: str, upserted: DataFrame, existing: DataFrame) -> Staged:
    """A dimension with the names that the months add; the file of known ones stays, new ones are appended."""
    staged = stage(upserted, name, measured=True)
    id_name = name.replace("dim_", "") + "_id"
    last = existing.agg(F.max(id_name)).first()[0] or 0
    added = staged.df.filter(F.col(id_name) > last)
    if not added.isEmpty():
        added.write.mode("append").parquet(f"{folder}/{name}")
    return staged


def _contents(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number and hash of the rows per month."""
    digest = F.sum(F.xxhash64(*sorted(columns)).cast("decimal(38,0)"))
    return rows.groupBy(_MONTH).agg(F.count(F.lit(1)).alias("n"), digest.alias("digest"))


def load_months(spark: SparkSession, root: str, silver: DataFrame, months: Sequence[int]) -> dict[str, list[int]]:
    """Bring the published star up to date with ``silver``, of which only ``months`` have changed.

    Returns the months rewritten by table. Fact and monthly marts take the months given; dimensions grow by
    the names in them. Flags depend on statistics of all time, so the anomalies are worked out anew, but
    only months whose rows differ are written, and with them their risk scores. The result equals a full
    reload but for ids of new names, which go on from the last one. The version is changed in place, one
    month after the other: readers wait until it ends, and a run that broke off is repeated.
    """
    folder, months = current_folder(spark, root), sorted(set(months))
    if folder is None:
        raise FileNotFoundError(f"nothing has been published under {root}")
    published = current_tables(spark, root, list(STAR.values()))
    touched = stage(silver.filter(F.col(_MONTH).isin(months)), "touched-months").df
    rows = serving.stage_silver(touched)
    vendors = serving.upsert_dim_vendor(serving.vendor_candidates(rows), published["dim_vendor"])
    agencies = serving.upsert_dim_agency(serving.agency_candidates(rows), published["dim_agency"])
    dim_vendor = _grown(spark, folder, "dim_vendor", vendors, published["dim_vendor"])
    dim_agency = _grown(spark, folder, "dim_agency", agencies, published["dim_agency"])

    cleaned = gold_columns(touched)
    monthly = serving.stage_vendor_monthly(gold.vendor_monthly_spend(cleaned))
    by_agency = serving.stage_agency_category(gold.agency_category_spend(cleaned))
    _replace_months(spark, folder, "fact_transactions_clean", serving.load_fact(rows, dim_agency, dim_vendor), months)
    _replace_months(spark, folder, "vendor_monthly_spend", serving.load_vendor_monthly(monthly, dim_vendor), months)
    _replace_months(spark, folder, "agency_category_spend", serving.load_agency_category(by_agency, dim_agency), months)

    whole = gold_columns(silver)
    stats = stage(gold.category_stats(whole), "category-stats", measured=True)
    first_seen = stage(gold.vendor_first_seen(whole), "first-seen", measured=True)
    if not (fits_broadcast(first_seen) and fits_broadcast(dim_vendor)):  # all rows to their vendor once, not twice
        first_seen = stage(serving.vendor_lookup(first_seen, dim_vendor), "vendor-lookup", measured=True)
    flagged = serving.stage_anomaly(gold.transaction_anomaly(whole, stats, first_seen))
    mart = stage(serving.load_anomaly(flagged, dim_agency, dim_vendor), "anomalies").df
    was = _contents(published["transaction_anomaly"], mart.columns).withColumnsRenamed({"n": "n_before", "digest": "digest_before"})
    both = _contents(mart, mart.columns).join(was, _MONTH, "full")
    differs = ~F.col("n").eqNullSafe(F.col("n_before")) | ~F.col("digest").eqNullSafe(F.col("digest_before"))
    changed = sorted(r[0] for r in both.filter(differs).select(_MONTH).collect())
    if changed:
        _replace_months(spark, folder, "transaction_anomaly", mart, changed)
        risk = serving.vendor_risk_monthly(mart.filter(F.col(_MONTH).isin(changed)), dim_vendor)
        _replace_months(spark, folder, "vendor_risk_scores", risk, changed)
    done = {table: months for table in FACT_PARTITIONS}
    return done | {"transaction_anomaly": changed, "vendor_risk_scores": changed}
