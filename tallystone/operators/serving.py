"""Serving: typed stage tables to a star schema of two dimensions, a fact and four marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallystone.functions import flags, money, rules, text
from tallystone.functions.dates import yyyymm
from tallystone.operators.gold import MATCHED, SUMS
from tallystone.operators.lookup import attach, fits_broadcast
from tallystone.operators.ranking import dense_ids
from tallystone.sources.tables import Staged, stage

# ---- stage tables -----------------------------------------------------------------------

STAGE_SILVER = rules.STAGE_SILVER
STAGE_VENDOR_MONTHLY = rules.STAGE_VENDOR_MONTHLY
STAGE_AGENCY_CATEGORY = rules.STAGE_AGENCY_CATEGORY
STAGE_ANOMALY = rules.STAGE_ANOMALY


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns picked by name; what does not fit its type becomes NULL (see ``stage_rejects``, ``require_fitting``).

    Takes Parquet or exported CSV alike.
    """
    carried = [name for name in (MATCHED, "first_seen_month") if name in df.columns and MATCHED in df.columns]
    return df.select(*[F.col(name).try_cast(to).alias(name) for name, to in types.items()], *carried)


def stage_rejects(df: DataFrame, types: dict[str, str], key: str = "transaction_id") -> DataFrame:
    """``key, column_name, text`` of every value that staging would lose: not NULL as it is, NULL in its type."""
    lost = [
        F.when(F.col(name).isNotNull() & F.col(name).try_cast(to).isNull(), F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("text")))
        for name, to in types.items()
    ]
    found = df.select(F.col(key).cast("string").alias(key), F.explode(F.array_compact(F.array(*lost))).alias("lost"))
    return found.select(key, "lost.*")


def require_fitting(df: DataFrame, types: dict[str, str], table: str) -> None:
    """Raise when a value does not fit its type; one pass that counts, per column, what would be lost."""
    lost = [F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(to).isNull()).alias(name) for name, to in types.items()]
    broken = {name: n for name, n in df.agg(*lost).first().asDict().items() if n}
    if broken:
        raise ValueError(f"values that do not fit their types in {table}: {broken}")


def stage_silver(silver: DataFrame) -> DataFrame:
    return _typed(silver, STAGE_SILVER)


def stage_vendor_monthly(gold: DataFrame) -> DataFrame:
    return _with_average(_typed(gold, STAGE_VENDOR_MONTHLY))


def stage_agency_category(gold: DataFrame) -> DataFrame:
    return _with_average(_typed(gold, STAGE_AGENCY_CATEGORY))


def stage_anomaly(gold: DataFrame) -> DataFrame:
    return _typed(gold, STAGE_ANOMALY)


def _with_average(staged: DataFrame) -> DataFrame:
    return staged.withColumn("avg_spend", money.exact_average(F.col("total_spend"), F.col("txn_count")))


# ---- dimensions -------------------------------------------------------------------------


def agency_candidates(*tables: DataFrame) -> DataFrame:
    """Distinct trimmed agency names of all tables, blanks dropped."""
    return _names("agency_name", tables, agency_name=text.normalize_agency(F.col("agency_name")))


def vendor_candidates(*tables: DataFrame) -> DataFrame:
    """Distinct vendors of all tables with their natural key."""
    name = F.col("vendor_name")
    return _names("vendor_name", tables, vendor_name_clean=text.normalize_vendor(name)).select(
        text.vendor_key(F.col("vendor_name_clean")).alias("vendor_key"), "vendor_name_clean"
    )


def _names(column: str, tables: Sequence[DataFrame], **normalised: Column) -> DataFrame:
    # The distinct combines on the map side: what is shuffled is already as small as the dimension.
    present = [table.select(column).filter(~text.is_blank(F.col(column))) for table in tables]
    names = reduce(DataFrame.unionByName, present)
    return names.select(*[name.alias(alias) for alias, name in normalised.items()]).distinct()


def upsert_dim_agency(candidates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _upsert(candidates, existing, "agency_name", "agency_id", F.md5("agency_name"))


def upsert_dim_vendor(candidates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _upsert(candidates, existing, "vendor_key", "vendor_id", F.col("vendor_key"))


def _upsert(candidates: DataFrame, existing: DataFrame | None, natural_key: str, id_name: str, md5: Column) -> DataFrame:
    """Existing rows untouched, unseen keys appended with the next ids in md5 order."""
    unseen, last_id = candidates, 0
    if existing is not None:
        unseen = candidates.join(existing.select(natural_key), natural_key, "left_anti")
        last_id = existing.agg(F.max(id_name)).first()[0] or 0
    # Written first: numbering reads the keys three times, and md5 is only worked out for distinct ones.
    unseen = stage(unseen.withColumn("md5_key", md5), "unseen-keys").df
    added = (
        dense_ids(unseen, "md5_key", id_name, start=last_id)
        .select(id_name, *candidates.columns)
        .withColumn("created_at", F.current_timestamp())
    )
    return added if existing is None else existing.unionByName(added)


# ---- fact and marts ---------------------------------------------------------------------


def _with_agency(df: DataFrame, dim_agency: Staged) -> DataFrame:
    return attach(
        df.withColumn("agency_name", text.normalize_agency(F.col("agency_name"))),
        dim_agency.select("agency_name", "agency_id"),
        "agency_name",
        how="inner",
    )


def _with_vendor(df: DataFrame, dim_vendor: Staged) -> DataFrame:
    """Vendors are matched on the normalised name: the same matches as on its md5, without a hash per row.

    Rows that carry their vendor's id (see ``vendor_lookup``) keep it and need no join.
    """
    named = df.withColumn("vendor_name_clean", text.normalize_vendor(F.col("vendor_name")))
    if MATCHED in df.columns:
        return named.filter(F.col(MATCHED).isNotNull()).withColumnRenamed(MATCHED, "vendor_id")
    return attach(
        named,
        dim_vendor.select("vendor_name_clean", "vendor_id"),
        "vendor_name_clean",
        how="inner",
    )


def vendor_lookup(first_seen: Staged, dim_vendor: Staged) -> DataFrame:
    """Vendor names as they are in gold with first month and id, so that rows are brought to their vendor once."""
    ids = dim_vendor.df.select(F.col("vendor_name_clean").alias("_clean"), F.col("vendor_id").alias(MATCHED))
    named = first_seen.df.withColumn("_clean", text.normalize_vendor(F.col("vendor_name")))
    return named.join(ids, "_clean", "left").drop("_clean")


def derive_period(df: DataFrame) -> DataFrame:
    """Year, month and yyyymm, taken from the date where they are NULL."""
    with_parts = df.withColumns(
        {
            "year": F.coalesce("year", F.year("transaction_date")),
            "month": F.coalesce("month", F.month("transaction_date")),
        }
    )
    return with_parts.withColumn("yyyymm", F.coalesce("yyyymm", yyyymm(F.col("year"), F.col("month"))))


def load_fact(staged_silver: DataFrame, dim_agency: Staged, dim_vendor: Staged) -> DataFrame:
    """Transactions with their dimension ids; rows without a known agency and vendor are dropped.

    So are rows whose id, date or amount is NULL; ``require_fitting`` tells values lost in staging apart.
    """
    complete = staged_silver.dropna(subset=["transaction_id", "transaction_date", "amount"])
    return (
        complete.transform(derive_period)
        .transform(_with_vendor, dim_vendor)
        .transform(_with_agency, dim_agency)
        .select(
            "transaction_id", "agency_id", "vendor_id", "transaction_date", "year", "month", "yyyymm",
            "amount", "mcc_description", "description", "category_group", "amount_bucket",
            "is_weekend", "day_of_week",
        )
    )


def name_vendor_monthly(staged: DataFrame) -> DataFrame:
    """The rows of ``load_vendor_monthly`` under their names, without ids: every name that is not blank has one."""
    named = staged.filter(~text.is_blank(F.col("vendor_name"))).withColumnsRenamed({"vendor_name": "vendor_name_clean"})
    clean = text.normalize_vendor(F.col("vendor_name_clean"))
    return named.withColumns({"yyyymm": yyyymm(F.col("year"), F.col("month")), "vendor_name_clean": clean})


def name_agency_category(staged: DataFrame) -> DataFrame:
    """The rows of ``load_agency_category`` under their names, without ids."""
    named = staged.filter(~text.is_blank(F.col("agency_name")))
    clean = text.normalize_agency(F.col("agency_name"))
    return named.withColumns({"yyyymm": yyyymm(F.col("year"), F.col("month")), "agency_name": clean})


def name_flags(staged: DataFrame) -> DataFrame:
    """Month and both flags of the rows of ``load_anomaly``, without ids."""
    known = F.col("transaction_id").isNotNull() & ~text.is_blank(F.col("vendor_name")) & ~text.is_blank(F.col("agency_name"))
    return staged.filter(known).select(
        yyyymm(F.col("year"), F.col("month")).alias("yyyymm"),
        (F.col("is_outlier") == 1).alias("is_outlier"),
        (F.col("is_new_vendor_month") == 1).alias("is_new_vendor"),
    )


def load_vendor_monthly(staged: DataFrame, dim_vendor: Staged) -> DataFrame:
    return _with_vendor(staged, dim_vendor).select(
        yyyymm(F.col("year"), F.col("month")).alias("yyyymm"),
        "year", "month", "vendor_id", "vendor_name_clean", "txn_count", "total_spend", "avg_spend",
    )


def load_agency_category(staged: DataFrame, dim_agency: Staged) -> DataFrame:
    return _with_agency(staged, dim_agency).select(
        yyyymm(F.col("year"), F.col("month")).alias("yyyymm"),
        "year", "month", "agency_id", "agency_name", "category_group", "txn_count", "total_spend", "avg_spend",
    )


# The names behind the ids of a mart's rows.
NAMES = ["agency_name", "vendor_name_clean"]


def load_anomaly(
    staged: DataFrame, dim_agency: Staged, dim_vendor: Staged, high_amount: float = rules.HIGH_AMOUNT, named: bool = False
) -> DataFrame:
    """Flagged transactions with ids, boolean flags and the strongest reason; ``named`` keeps the ids' names as well."""
    joined = (
        staged.dropna(subset=["transaction_id"]).transform(_with_vendor, dim_vendor).transform(_with_agency, dim_agency)
    )
    outlier, new_vendor = F.col("is_outlier") == 1, F.col("is_new_vendor_month") == 1
    high = flags.is_high_amount(F.col("amount"), high_amount)
    return joined.select(
        "transaction_id",
        yyyymm(F.col("year"), F.col("month")).alias("yyyymm"),
        "transaction_date",
        "amount",
        "agency_id",
        "vendor_id",
        "category_group",
        outlier.alias("is_outlier"),
        new_vendor.alias("is_new_vendor"),
        high.alias("is_high_amount"),
        flags.anomaly_reason(outlier, new_vendor, high).alias("anomaly_reason"),
        *(NAMES if named else []),
    )


def vendor_risk_monthly(anomaly: DataFrame, dim_vendor: Staged) -> DataFrame:
    """Score per vendor and month. Flags are summed by id first; names are attached to the few sums.

    A vendor has at most one sum a month, so no vendor's sums are many and a large dimension is joined as it is.
    Rows with their months' ``SUMS`` have names and ids already, and nothing is left to add.
    """
    if SUMS in anomaly.columns:
        flagged = anomaly.filter(F.col(MATCHED).isNotNull() & (F.col(SUMS)["known"] > 0))
        named = flagged.select(
            yyyymm(F.col("year"), F.col("month")).alias("yyyymm"),
            F.col(MATCHED).alias("vendor_id"),
            text.normalize_vendor(F.col("vendor_name")).alias("vendor_name_clean"),
            f"{SUMS}.outlier_txn",
            f"{SUMS}.new_vendor_txn",
        )
    else:
        sums = anomaly.groupBy("yyyymm", "vendor_id").agg(
            F.count_if("is_outlier").alias("outlier_txn"), F.count_if("is_new_vendor").alias("new_vendor_txn")
        )
        names = dim_vendor.select("vendor_id", "vendor_name_clean")
        named = sums.join(F.broadcast(names.df) if fits_broadcast(names) else names.df, "vendor_id")
    return named.select(
        "yyyymm",
        "vendor_id",
        "vendor_name_clean",
        "outlier_txn",
        "new_vendor_txn",
        flags.monthly_risk_score(F.col("outlier_txn"), F.col("new_vendor_txn")).alias("risk_score"),
    )


def audit_column(df: DataFrame, name: str = "created_at") -> DataFrame:
    """Stamp rows with the load time."""
    return df.withColumn(name, F.current_timestamp())
