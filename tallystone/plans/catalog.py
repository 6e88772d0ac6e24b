"""One named query per operator, over the whole test tables.

Statistics are rounded to 4 and scores to 6 places here, and only here, so that results can be
compared with another engine's floating-point sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallystone.functions import dates, flags, money, text
from tallystone.functions.rules import FIELD_ALIASES
from tallystone.operators import activity, gold, integrity, matching, quality, quantiles, reports, risk, serving, silver
from tallystone.operators.lookup import attach
from tallystone.operators.ranking import percent_rank
from tallystone.plans import increments, jobs, namespaces
from tallystone.plans.warehouse import Warehouse
from tallystone.sources import bronze as bronze_files
from tallystone.sources.columns import gold_columns, missing, resolve_fields
from tallystone.sources.fixture import spend_bronze
from tallystone.sources.tables import CODEC, Staged, export_csv, read_csv, read_table, scratch_path, stage, write_table
from tallystone.sources.versions import VersionFolder, current_tables
from tallystone.streaming import arrivals, silver as silver_stream

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spend_bronze(spark, sf_dir))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.project_raw(spend_bronze(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.type_money_and_time(_raw(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that read silver once: not staged."""
    return silver.build_silver(spend_bronze(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_columns(silver.build_silver(spend_bronze(spark, sf_dir), silver.GOLD_INPUT))


def _rounded(name: str, digits: int) -> Column:
    return F.round(name, digits).alias(name)


def _round_stats(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.round(name, 4) for name in ("mean_amount", "std_amount")})


# ---- sources ----------------------------------------------------------------------------


def _drop_csv_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw rows as two CSV drops with different headers and column orders; returns the drop folder."""
    folder = scratch_path(spark, "drop")
    rows = stage(_raw(spark, sf_dir), "raw").df
    drops = {
        "purchase_card_20240201_000000.csv": (0, "ObjectID Agency Vendor Category Transaction_Date Amount Description"),
        "purchase_card_20240301_000000.csv": (1, "dept supplier id dollars posted_date merchant_category item_description"),
    }
    fields = {
        "objectid": "transaction_id", "id": "transaction_id", "agency": "agency_name", "dept": "agency_name",
        "vendor": "vendor_name", "supplier": "vendor_name", "category": "mcc_description",
        "merchant_category": "mcc_description", "transaction_date": "transaction_date_raw",
        "posted_date": "transaction_date_raw", "amount": "amount_raw", "dollars": "amount_raw",
        "description": "description", "item_description": "description",
    }
    for name, (parity, headers) in drops.items():
        half = rows.filter(F.col("transaction_id").cast("bigint") % 2 == parity)
        half = half.select(*[F.col(fields[header.lower()]).alias(header) for header in headers.split()])
        # The drop's name is the folder's; part files inside share its header.
        half.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(f"{folder}/{name}")
    return folder


@query
def read_bronze_csv(spark, sf_dir):
    return bronze_files.read_bronze_csv(spark, f"{_drop_csv_files(spark, sf_dir)}/*").drop(silver.SNAPSHOT)


@query
def land_bronze(spark, sf_dir):
    target = scratch_path(spark, "bronze")
    return bronze_files.land_bronze(spark, f"{_drop_csv_files(spark, sf_dir)}/*", target)


@query
def land_arrivals(spark, sf_dir):
    """The same drops, discovered by the file stream."""
    target = scratch_path(spark, "bronze")
    drop, checkpoint = _drop_csv_files(spark, sf_dir), scratch_path(spark, "arrivals")
    arrivals.land_arrivals(spark, f"{drop}/*", target, checkpoint).awaitTermination()
    return bronze_files.read_bronze(spark, target)


@query
def read_table_columns(spark, sf_dir):
    path = scratch_path(spark, "silver")
    write_table(_silver(spark, sf_dir), path)
    return read_table(spark, path).select("transaction_id", "transaction_date", "amount")


@query
def write_table_by_month(spark, sf_dir):
    path = scratch_path(spark, "silver-by-month")
    write_table(_silver(spark, sf_dir), path, partition_by=["yyyymm"])
    return (
        read_table(spark, path)
        .groupBy("yyyymm")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount"))
    )


@query
def export_csv_round_trip(spark, sf_dir):
    """The whole silver table, padded names and NULLs included, through CSV and back."""
    path = scratch_path(spark, "silver-csv")
    whole = stage(_silver(spark, sf_dir), "silver").df
    export_csv(whole, path)
    back = read_csv(spark, path, whole.columns)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in whole.schema.fields])


@query
def stage_rejects(spark, sf_dir):
    """Silver with some texts spoilt: amounts beyond the type, dates off the calendar, flags that are none."""
    order = F.col("transaction_id").cast("bigint")
    spoilt = _silver(spark, sf_dir).withColumns(
        {
            "amount": F.when(order % 7 == 0, F.concat(F.col("amount").cast("string"), F.lit("e17"))).otherwise(F.col("amount").cast("string")),
            "transaction_date": F.when(order % 11 == 0, "2024-13-01").otherwise(F.col("transaction_date").cast("string")),
            "is_weekend": F.when(order % 13 == 0, "perhaps").otherwise(F.col("is_weekend").cast("string")),
        }
    )
    return serving.stage_rejects(spoilt, serving.STAGE_SILVER)


@query
def missing_fields(spark, sf_dir):
    """Which required fields a table without some columns lacks, and how many rows that concerns."""
    bare = spend_bronze(spark, sf_dir).drop("vendor_name", "amount", "description")
    found = missing(resolve_fields(bare.columns))
    counted = bare.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.explode(F.array(*map(F.lit, found))).alias("field"), "row_count")


@query
def stage_silver(spark, sf_dir):
    return serving.stage_silver(_silver(spark, sf_dir))


@query
def stage_vendor_monthly(spark, sf_dir):
    return serving.stage_vendor_monthly(gold.vendor_monthly_spend(_cleaned(spark, sf_dir)))


@query
def stage_agency_category(spark, sf_dir):
    return serving.stage_agency_category(gold.agency_category_spend(_cleaned(spark, sf_dir)))


@query
def stage_anomaly(spark, sf_dir):
    return _warehouse(spark, sf_dir).stage_anomaly


# ---- column resolution ------------------------------------------------------------------


@query
def optional_fields(spark, sf_dir):
    without = spend_bronze(spark, sf_dir).drop("mcc_description", "description")
    return silver.project_raw(without).select("transaction_id", "mcc_description", "description")


@query
def gold_fallback_columns(spark, sf_dir):
    bare = _silver(spark, sf_dir).drop("vendor_name_clean", "agency_name_clean", "category_group", "mcc_description")
    return gold_columns(bare)


# ---- silver -----------------------------------------------------------------------------


@query
def project_raw(spark, sf_dir):
    return _raw(spark, sf_dir)


@query
def clean_amount(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "transaction_id", "amount_raw", money.clean_amount(F.col("amount_raw")).alias("amount")
    )


@query
def normalize_date_text(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "transaction_id", dates.normalize_date_text(F.col("transaction_date_raw")).alias("date_text")
    )


@query
def parse_timestamp(spark, sf_dir):
    return _typed(spark, sf_dir).select("transaction_id", "transaction_date_raw", "transaction_ts")


@query
def midnight_fallback(spark, sf_dir):
    """Every line's ship date with an out-of-range, a partial or a full time of day."""
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet")
    clock = F.element_at(F.array(*map(F.lit, (" 25:00:00", " 10:20", " 7:08:09"))), F.col("l_linenumber") % 3 + 1)
    written = F.concat(F.substring(F.col("l_shipdate").cast("string"), 1, 10), clock)
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("transaction_id"),
        dates.parse_timestamp(written).alias("transaction_ts"),
    )


@query
def transaction_date(spark, sf_dir):
    return _typed(spark, sf_dir).select("transaction_id", F.to_date("transaction_ts").alias("transaction_date"))


@query
def filter_valid(spark, sf_dir):
    return silver.filter_valid(_typed(spark, sf_dir))


@query
def normalize_vendor(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "transaction_id", text.normalize_vendor(F.col("vendor_name")).alias("vendor_name_clean")
    )


@query
def normalize_agency(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "transaction_id", text.normalize_agency(F.col("agency_name")).alias("agency_name_clean")
    )


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich(silver.filter_valid(_typed(spark, sf_dir)))


@query
def calendar_features(spark, sf_dir):
    return _enriched(spark, sf_dir).select("transaction_id", "year", "month", "yyyymm")


@query
def weekday_features(spark, sf_dir):
    return _enriched(spark, sf_dir).select("transaction_id", "day_of_week", "is_weekend")


@query
def amount_bucket(spark, sf_dir):
    return _enriched(spark, sf_dir).select("transaction_id", "amount", "amount_bucket")


@query
def category_group(spark, sf_dir):
    return _silver(spark, sf_dir).select("transaction_id", "mcc_description", "category_group")


@query
def dedup_transactions(spark, sf_dir):
    return silver.dedup_transactions(_typed(spark, sf_dir), where=silver.is_valid())


@query
def dedup_repeats(spark, sf_dir):
    """The survivors again, found by shuffling only the rows whose id occurs more than once."""
    typed = silver.type_money_and_time(stage(_raw(spark, sf_dir), "raw").df)
    return silver.dedup_repeats(typed, where=silver.is_valid())


@query
def silver_of_two_snapshots(spark, sf_dir):
    """Every id in an older snapshot, a third of them in a newer one with other amounts and earlier dates."""
    older = _raw(spark, sf_dir).withColumn(silver.SNAPSHOT, F.lit("20240201_000000"))
    newer = older.filter(F.col("transaction_id").cast("bigint") % 3 == 0).withColumns(
        {"amount_raw": F.lit("$1.25"), "transaction_date_raw": F.lit("1990-01-02"), silver.SNAPSHOT: F.lit("20240301_000000")}
    )
    survivors = silver.build_silver(older.unionByName(newer))
    return survivors.select("transaction_id", "amount", "transaction_date", "amount_bucket")


@query
def build_silver(spark, sf_dir):
    return _silver(spark, sf_dir)


def _three_drops(spark: SparkSession, sf_dir: str, bronze: str) -> Iterator[DataFrame]:
    """Rows of three snapshots: all ids, a third of them again with other amounts and dates, a fifth of an older state.

    Each is to be landed before the next is asked for: the later ones are spelled from the first as it landed.
    """
    stamps = ["20240201_000000", "20240301_000000", "20240101_000000"]
    yield _raw(spark, sf_dir).withColumn(silver.SNAPSHOT, F.lit(stamps[0]))
    rows = read_table(spark, f"{bronze}/{silver.SNAPSHOT}={stamps[0]}").select(*FIELD_ALIASES)
    order = F.col("transaction_id").cast("bigint")
    moved = {"amount_raw": F.lit("$1.25"), "transaction_date_raw": F.lit("1996-03-02")}
    yield rows.filter(order % 3 == 0).withColumns(moved | {silver.SNAPSHOT: F.lit(stamps[1])})
    stale = {"amount_raw": F.lit("$9999.99"), "transaction_date_raw": F.lit("1990-01-02")}
    yield rows.filter(order % 5 == 0).withColumns(stale | {silver.SNAPSHOT: F.lit(stamps[2])})


@query
def stream_silver(spark, sf_dir):
    """Three drops, each merged into silver by a run of the stream as it lands."""
    bronze, path, checkpoint = (scratch_path(spark, name) for name in ("bronze", "silver", "silver-stream"))
    for k, drop in enumerate(_three_drops(spark, sf_dir, bronze)):
        landed = drop.withColumn(bronze_files.BATCH_ID, F.lit(f"b{k}"))
        landed.write.mode("append").partitionBy(silver.SNAPSHOT, bronze_files.BATCH_ID).parquet(bronze, compression=CODEC)
        silver_stream.refresh_silver(spark, bronze, path, checkpoint).awaitTermination()
    return read_table(spark, path).select("transaction_id", "amount", "transaction_date", "amount_bucket")


# ---- gold -------------------------------------------------------------------------------


@query
def amount_num(spark, sf_dir):
    return _silver(spark, sf_dir).select("transaction_id", money.amount_num(F.col("amount")).alias("amount_num"))


@query
def vendor_monthly_spend(spark, sf_dir):
    return gold.vendor_monthly_spend(_cleaned(spark, sf_dir))


@query
def agency_category_spend(spark, sf_dir):
    return gold.agency_category_spend(_cleaned(spark, sf_dir))


@query
def sort_by_spend(spark, sf_dir):
    return gold.sort_by_spend(gold.agency_category_spend(_cleaned(spark, sf_dir)))


@query
def category_stats(spark, sf_dir):
    return _round_stats(gold.category_stats(_cleaned(spark, sf_dir)))


@query
def vendor_first_seen(spark, sf_dir):
    return gold.vendor_first_seen(_cleaned(spark, sf_dir))


@query
def join_category_stats(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    joined = gold.join_category_stats(w.cleaned, w.category_stats)
    return _round_stats(joined.select("transaction_id", "merchant_category", "mean_amount", "std_amount"))


@query
def join_first_seen(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    return gold.join_first_seen(w.cleaned, w.first_seen).select("transaction_id", "vendor_name", "first_seen_month")


@query
def txn_month(spark, sf_dir):
    return _silver(spark, sf_dir).select("transaction_id", gold.txn_month().alias("txn_month"))


@query
def is_outlier(spark, sf_dir):
    return _warehouse(spark, sf_dir).anomaly.select("transaction_id", "amount", "is_outlier")


@query
def is_new_vendor_month(spark, sf_dir):
    return _warehouse(spark, sf_dir).anomaly.select("transaction_id", "vendor_name", "is_new_vendor_month")


@query
def transaction_anomaly(spark, sf_dir):
    return _round_stats(_warehouse(spark, sf_dir).anomaly)


# ---- risk over all time -----------------------------------------------------------------


@query
def risk_input(spark, sf_dir):
    return risk.risk_input(_warehouse(spark, sf_dir).anomaly)


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.vendor_rollup(risk.risk_input(_warehouse(spark, sf_dir).anomaly))


@query
def vendor_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir)


@query
def outlier_rate(spark, sf_dir):
    return risk.outlier_rate(_rollup(spark, sf_dir)).select("vendor_name", "outlier_rate")


@query
def spend_percent_rank(spark, sf_dir):
    totals = stage(_cleaned(spark, sf_dir).groupBy("vendor_name").agg(F.sum("amount").alias("total_spend")), "totals")
    return percent_rank(totals.df, "total_spend", "spend_rank")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.vendor_risk_scored(_warehouse(spark, sf_dir).anomaly)


@query
def risk_score_raw(spark, sf_dir):
    return _scored(spark, sf_dir).select("vendor_name", _rounded("risk_score_raw", 6))


@query
def risk_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("vendor_name", _rounded("risk_score", 6))


@query
def vendor_risk_all_time(spark, sf_dir):
    return _warehouse(spark, sf_dir).vendor_risk.withColumn("risk_score", F.round("risk_score", 6))


# ---- serving ----------------------------------------------------------------------------


@query
def agency_candidates(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    return serving.agency_candidates(w.stage_silver, w.stage_agency_category, w.stage_anomaly)


@query
def upsert_dim_agency(spark, sf_dir):
    return _warehouse(spark, sf_dir).dim_agency.df.drop("created_at")


@query
def vendor_candidates(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    return serving.vendor_candidates(w.stage_silver, w.stage_vendor_monthly, w.stage_anomaly)


@query
def upsert_dim_vendor(spark, sf_dir):
    return _warehouse(spark, sf_dir).dim_vendor.df.drop("created_at")


@query
def upsert_dim_vendor_second_load(spark, sf_dir):
    """A first load up to 1995, then one of everything: known vendors keep their ids."""
    monthly = stage(gold.vendor_monthly_spend(_cleaned(spark, sf_dir)), "vendor-monthly").df
    early = serving.vendor_candidates(monthly.filter("year <= 1995"))
    first_load = stage(serving.upsert_dim_vendor(early), "first-load").df
    return serving.upsert_dim_vendor(serving.vendor_candidates(monthly), first_load).drop("created_at")


@query
def upsert_dim_agency_second_load(spark, sf_dir):
    """A first load up to 1995, then one of everything: known agencies keep their ids."""
    monthly = stage(gold.agency_category_spend(_cleaned(spark, sf_dir)), "agency-category").df
    early = serving.agency_candidates(monthly.filter("year <= 1995 and agency_name < 'G'"))
    first_load = stage(serving.upsert_dim_agency(early), "first-load").df
    return serving.upsert_dim_agency(serving.agency_candidates(monthly), first_load).drop("created_at")


@query
def audit_columns(spark, sf_dir):
    """Rows of the fact per month, and how many of them carry a load time of today."""
    stamped = serving.audit_column(_warehouse(spark, sf_dir).fact, "ingested_at")
    recent = F.col("ingested_at").between(F.current_timestamp() - F.expr("interval 1 day"), F.current_timestamp())
    return stamped.groupBy("yyyymm").agg(F.count(F.lit(1)).alias("row_count"), F.count_if(recent).alias("stamped"))


@query
def load_fact(spark, sf_dir):
    return _warehouse(spark, sf_dir).fact


@query
def derive_period(spark, sf_dir):
    """Periods blanked out in part, then derived again."""
    line = F.substring("transaction_id", -1, 1).cast("int")
    blanked = serving.stage_silver(_silver(spark, sf_dir)).withColumns(
        {
            "year": F.when(line % 2 == 0, F.col("year")),
            "month": F.when(line % 3 == 0, F.col("month")),
            "yyyymm": F.when(line % 5 == 0, F.col("yyyymm")),
        }
    )
    return serving.derive_period(blanked).select("transaction_id", "year", "month", "yyyymm")


@query
def load_vendor_monthly(spark, sf_dir):
    return _warehouse(spark, sf_dir).mart_vendor_monthly


@query
def load_agency_category(spark, sf_dir):
    return _warehouse(spark, sf_dir).mart_agency_category


@query
def vendor_risk_monthly(spark, sf_dir):
    return _warehouse(spark, sf_dir).mart_vendor_risk


@query
def load_anomaly(spark, sf_dir):
    return _warehouse(spark, sf_dir).mart_anomaly


@query
def is_high_amount(spark, sf_dir):
    return _silver(spark, sf_dir).select("transaction_id", flags.is_high_amount(F.col("amount")).alias("is_high_amount"))


@query
def anomaly_reason(spark, sf_dir):
    return _warehouse(spark, sf_dir).mart_anomaly.select("transaction_id", "anomaly_reason")


@query
def full_reload(spark, sf_dir):
    """Publish a checked version of the whole star and count what readers see."""
    root = scratch_path(spark, "corp")
    warehouse = _warehouse(spark, sf_dir)
    jobs.reload_star(spark, warehouse, root)
    return reports.row_counts(current_tables(spark, root, list(warehouse.star())))


@query
def full_reload_content(spark, sf_dir):
    """The published anomaly mart after a second publication of the same star."""
    root = scratch_path(spark, "corp")
    warehouse = _warehouse(spark, sf_dir)
    jobs.reload_star(spark, warehouse, root)
    jobs.reload_star(spark, warehouse, root, keep_versions=1)
    return current_tables(spark, root, ["transaction_anomaly"])["transaction_anomaly"].drop("created_at")


def _loaded_by_months(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A star of everything but two months, which are loaded afterwards."""
    root = scratch_path(spark, "corp")
    whole = stage(_silver(spark, sf_dir), "silver").df
    late = [199603, 199711]
    jobs.reload_star(spark, Warehouse.from_tables(silver=whole.filter(~F.col("yyyymm").isin(late))), root)
    increments.load_months(spark, root, whole, late)
    return current_tables(spark, root, ["fact_transactions_clean", "transaction_anomaly", "vendor_monthly_spend", "vendor_risk_scores", "dim_vendor"])


@query
def load_months(spark, sf_dir):
    """Flags of the whole star, with vendors' names, after a first load and one of two more months."""
    star = _loaded_by_months(spark, sf_dir)
    names = Staged(star["dim_vendor"]).select("vendor_id", "vendor_name_clean")
    named = attach(star["transaction_anomaly"], names, "vendor_id", how="inner")
    return named.select("transaction_id", "yyyymm", "amount", "vendor_name_clean", "is_outlier", "is_new_vendor", "anomaly_reason")


@query
def load_months_counts(spark, sf_dir):
    star = _loaded_by_months(spark, sf_dir)
    return reports.row_counts({name: star[name] for name in sorted(star)})


@query
def sql_over_published_views(spark, sf_dir):
    """An analyst's SQL over the views of a published star."""
    root = scratch_path(spark, "corp")
    jobs.reload_star(spark, _warehouse(spark, sf_dir), root)
    namespaces.register(namespaces.published_warehouse(spark, root))
    return spark.sql(
        "select k.*, m.year_month, m.month_name, m.month_short, m.month_start "
        "from bi_v_exec_kpi k join bi_v_dim_month m using (yyyymm)"
    )


@query
def check_integrity(spark, sf_dir):
    """A written star with faults of each kind: repeated keys, NULLs, and ids that no dimension has."""
    warehouse = _warehouse(spark, sf_dir)
    star = dict(warehouse.star())
    fact = stage(star["fact_transactions_clean"], "fact").df
    order = F.col("transaction_id").cast("bigint")
    repeated = fact.filter(order % 97 == 0)
    spoilt = fact.withColumns(
        {
            "amount": F.when(order % 89 != 0, F.col("amount")),
            "vendor_id": F.when(order % 83 == 0, -F.col("vendor_id")).otherwise(F.col("vendor_id")),
        }
    )
    star["fact_transactions_clean"] = stage(spoilt.unionByName(repeated), "spoilt-fact").df
    star["dim_agency"] = star["dim_agency"].filter("agency_id > 2")
    return integrity.star_violations({name: star[name] for name in ("fact_transactions_clean", "dim_agency", "dim_vendor")})


def _spoilt_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a fact written with faults: amounts missing, negative or zero, and dates of another age."""
    fact = _warehouse(spark, sf_dir).fact
    order = F.col("transaction_id").cast("bigint")
    spoilt = fact.withColumns(
        {
            "amount": F.when(order % 89 == 0, None).when(order % 97 == 0, -F.col("amount")).otherwise(F.col("amount")),
            "transaction_date": F.when(order % 83 == 0, F.lit("1850-01-01").cast("date")).otherwise(F.col("transaction_date")),
        }
    )
    folder = VersionFolder(spark, scratch_path(spark, "version"), measures=quality.measures)
    folder.write("fact_transactions_clean", spoilt)
    return quality.metric_rows(spark, folder.metrics)


@query
def quality_metrics(spark, sf_dir):
    """What the writes of a published star counted."""
    root = scratch_path(spark, "corp")
    jobs.reload_star(spark, _warehouse(spark, sf_dir), root)
    metrics = current_tables(spark, root, [jobs.METRICS])[jobs.METRICS]
    return metrics.withColumn("value", F.round("value", 6))


@query
def quality_breaches(spark, sf_dir):
    """The limits that a spoilt fact breaks, by what its write counted."""
    limits = [x for x in quality.default_limits() if x.table == "fact_transactions_clean"]
    return quality.breaches(_spoilt_metrics(spark, sf_dir), limits)


# ---- percentile outliers ----------------------------------------------------------------


def _with_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = _warehouse(spark, sf_dir).cleaned
    return cleaned.withColumn("cents", quantiles.cents(F.col("amount")))


@query
def percentile_outliers(spark, sf_dir):
    rows = _with_cents(spark, sf_dir)
    bounds = quantiles.exact_bounds(rows, "merchant_category", "cents")
    return quantiles.percentile_outliers(rows, bounds)


@query
def percentile_bounds_of_vendors(spark, sf_dir):
    """Median and 90 % bound per vendor: many keys of a few rows each."""
    return quantiles.exact_bounds(_with_cents(spark, sf_dir), "vendor_name", "cents", shares=(0.5, 0.9))


@query
def percentile_sketches(spark, sf_dir):
    """Bounds from merged monthly sketches, and whether their ranks are within 1 % of those asked for."""
    rows = _with_cents(spark, sf_dir)
    monthly = stage(quantiles.value_sketches(rows, ["merchant_category", "year", "month"], "cents"), "sketches").df
    bounds = stage(quantiles.sketched_bounds(monthly, "merchant_category"), "bounds", measured=True)
    joined = attach(rows.select("merchant_category", "cents"), bounds, "merchant_category", how="inner")
    shares = {"p95": 0.95, "p99": 0.99}
    below = [F.avg((F.col("cents") < F.col(n)).cast("int")).alias(f"below_{n}") for n in shares]
    upto = [F.avg((F.col("cents") <= F.col(n)).cast("int")).alias(f"upto_{n}") for n in shares]
    ranks = joined.groupBy("merchant_category").agg(F.count(F.lit(1)).alias("txn_count"), *below, *upto)
    near = [((F.col(f"below_{n}") <= s + 0.01) & (F.col(f"upto_{n}") >= s - 0.01)).alias(f"{n}_is_near") for n, s in shares.items()]
    return ranks.select("merchant_category", "txn_count", *near)


# ---- vendor matching --------------------------------------------------------------------


def _spelt_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vendor's name and number of transactions, and some misspelt once or twice."""
    names = _cleaned(spark, sf_dir).groupBy(F.col("vendor_name").alias("name")).agg(F.count(F.lit(1)).alias("weight"))
    names = stage(names.filter("trim(name) <> ''"), "names").df
    order = F.conv(F.substring(F.md5("name"), 1, 6), 16, 10).cast("bigint") % 10
    spelt = [(1, "SUPPLIER", "SUPLIER"), (2, "SUPPLIER", "SUPPLLIER"), (3, "BRAND", "BARND"), (3, "SUPPLIER", "SUPPIER"), (4, "BRAND", "BAND"), (5, "SUPPLIER#", "VENDOR #")]
    wrong = [names.filter(order == k).select(F.replace("name", F.lit(old), F.lit(new)).alias("name"), F.lit(1).cast("bigint").alias("weight")) for k, old, new in spelt]
    return reduce(DataFrame.unionByName, [names, *wrong])


@query
def misspellings(spark, sf_dir):
    return matching.misspellings(_spelt_names(spark, sf_dir))


@query
def vendor_groups(spark, sf_dir):
    return matching.vendor_groups(_spelt_names(spark, sf_dir))


# ---- spans of the calendar --------------------------------------------------------------


@query
def active_vendors_by_quarter(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    return activity.active_vendors(w.vendor_activity, year=activity.year(), quarter=activity.quarter())


@query
def active_vendors_by_year(spark, sf_dir):
    return activity.active_vendors(_warehouse(spark, sf_dir).vendor_activity, year=activity.year())


def _published(spark: SparkSession, sf_dir: str) -> Warehouse:
    root = scratch_path(spark, "corp")
    jobs.reload_star(spark, _warehouse(spark, sf_dir), root)
    return namespaces.published_warehouse(spark, root)


@query
def quarter_slice(spark, sf_dir):
    """The fact's second quarters, month by month, from their folders only."""
    w = _published(spark, sf_dir)
    months = stage(w.v_dim_month, "dim-month").df
    rows = reports.calendar_slice(w.fact, months, F.col("month").between(4, 6))
    return rows.groupBy("yyyymm", "year_month").agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("amount"))


@query
def weekday_slice(spark, sf_dir):
    """Anomalies of the Sundays of one year."""
    w = _published(spark, sf_dir)
    days = stage(w.v_dim_date, "dim-date").df
    sundays = (F.col("dow_0_sun") == 0) & (F.col("year") == 1996)
    return reports.calendar_slice(w.mart_anomaly.drop("created_at"), days, sundays, days=True)


# ---- views ------------------------------------------------------------------------------


@query
def v_vendor_monthly_spend(spark, sf_dir):
    return _warehouse(spark, sf_dir).v_vendor_monthly_spend


@query
def v_agency_category_spend(spark, sf_dir):
    return _warehouse(spark, sf_dir).v_agency_category_spend


@query
def v_transaction_anomaly(spark, sf_dir):
    return _warehouse(spark, sf_dir).v_transaction_anomaly


@query
def v_vendor_risk_scores(spark, sf_dir):
    return _warehouse(spark, sf_dir).v_vendor_risk_scores


@query
def v_dim_date(spark, sf_dir):
    return _warehouse(spark, sf_dir).v_dim_date


@query
def v_dim_month(spark, sf_dir):
    return _warehouse(spark, sf_dir).v_dim_month


@query
def v_exec_kpi(spark, sf_dir):
    return _warehouse(spark, sf_dir).v_exec_kpi


# ---- analyst queries and KPIs -----------------------------------------------------------


@query
def row_counts(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    stages = {"stage_silver": w.stage_silver}  # first: the star is made of silver, not of the raw rows once more
    w.place(always=True)
    stages |= {
        "stage_vendor_monthly": w.stage_vendor_monthly,
        "stage_agency_category": w.stage_agency_category,
        "stage_anomaly": w.stage_anomaly,
    }
    w.star()
    marts = {
        "fact": w.fact,
        "vendor_monthly": w.mart_vendor_monthly,
        "agency_category": w.mart_agency_category,
        "anomaly": w.mart_anomaly,
        "risk": w.mart_vendor_risk,
    }
    return reports.row_counts(marts | stages)


@query
def preview_view(spark, sf_dir):
    return reports.preview_view(_warehouse(spark, sf_dir).v_vendor_monthly_spend, ["yyyymm", "vendor_name_clean"])


@query
def preview_agency_category(spark, sf_dir):
    view = _warehouse(spark, sf_dir).v_agency_category_spend
    return reports.preview_view(view, ["yyyymm", "agency_name", "category_group"])


@query
def preview_transaction_anomaly(spark, sf_dir):
    return reports.preview_view(_warehouse(spark, sf_dir).v_transaction_anomaly, ["transaction_id"])


@query
def top_vendors(spark, sf_dir):
    return reports.top_vendors(_warehouse(spark, sf_dir).v_vendor_monthly_spend)


@query
def top_risk_scores(spark, sf_dir):
    return reports.top_risk_scores(_warehouse(spark, sf_dir).v_vendor_risk_scores)


@query
def top_risky_vendors(spark, sf_dir):
    return reports.top_risky_vendors(_warehouse(spark, sf_dir).v_vendor_risk_scores)


@query
def latest_anomalies(spark, sf_dir):
    return reports.latest_anomalies(_warehouse(spark, sf_dir).v_transaction_anomaly)


@query
def duplicate_months(spark, sf_dir):
    """A month dimension in which the months of one quarter are there twice."""
    months = stage(_warehouse(spark, sf_dir).v_dim_month, "dim-month").df
    return reports.duplicate_months(months.unionByName(months.filter("month between 4 and 6")))


@query
def concentration(spark, sf_dir):
    found = reports.concentration(_warehouse(spark, sf_dir).v_vendor_monthly_spend)
    return found.withColumns({name: F.round(name, 9) for name in ("share", "cumulative_share")})


@query
def kpi_totals(spark, sf_dir):
    return _warehouse(spark, sf_dir).kpi_totals


@query
def month_slice_exec_kpi(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    w.place()
    months = w.v_dim_month  # first: the fact needs more of silver than gold does
    return reports.month_slice(w.v_exec_kpi, months)


@query
def month_slice_vendor_monthly(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    months = w.v_dim_month  # first: the fact needs more of silver than gold does
    return reports.month_slice(w.v_vendor_monthly_spend, months)


@query
def month_slice_agency_category(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    months = w.v_dim_month  # first: the fact needs more of silver than gold does
    return reports.month_slice(w.v_agency_category_spend, months)


@query
def month_slice_vendor_risk(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    w.place()
    months = w.v_dim_month  # first: the fact needs more of silver than gold does
    return reports.month_slice(w.v_vendor_risk_scores, months)


@query
def month_slice_one_month(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    w.place()
    months = w.v_dim_month  # first: the fact needs more of silver than gold does
    return reports.month_slice(w.v_vendor_risk_scores, months, yyyymm=199603)


@query
def date_slice(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    w.place()
    days = stage(w.v_dim_date, "dim-date")
    return reports.date_slice(w.v_transaction_anomaly, days)
