"""Silver: raw text rows to one clean, typed row per transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallystone.functions import dates, money, text
from tallystone.functions.rules import FIELD_ALIASES
from tallystone.operators.lookup import fits_broadcast
from tallystone.sources.columns import optional_field, require_fields, resolve_fields
from tallystone.sources.tables import stage

# Where a row came from, if known (see sources.bronze): its snapshot's stamp.
SNAPSHOT = "snapshot"
# The texts of a row while it travels.
_TEXTS = "_texts"

SILVER_COLUMNS = [
    "transaction_id", "agency_name", "vendor_name", "mcc_description", "transaction_date_raw",
    "amount_raw", "description", "amount", "transaction_ts", "transaction_date",
    "vendor_name_clean", "agency_name_clean", "year", "month", "yyyymm", "day_of_week",
    "is_weekend", "amount_bucket", "category_group",
]


def project_raw(df: DataFrame) -> DataFrame:
    """The seven logical fields as text, whatever their headers; the snapshot is kept if present.

    A table that already has the logical names (a landed bronze table) passes unchanged.
    """
    origin = [name for name in (SNAPSHOT,) if name in df.columns]
    if set(FIELD_ALIASES) <= set(df.columns):
        return df.select(*FIELD_ALIASES, *origin)
    fields = resolve_fields(df.columns)
    require_fields(fields, df.columns)
    return df.select(*[optional_field(name).alias(field) for field, name in fields.items()], *origin)


def type_money_and_time(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        money.clean_amount(F.col("amount_raw")).alias("amount"),
        dates.parse_timestamp(F.col("transaction_date_raw")).alias("transaction_ts"),
    )


def is_valid() -> Column:
    """An id, a readable date and a positive amount."""
    return F.col("transaction_id").isNotNull() & F.col("transaction_ts").isNotNull() & (F.col("amount") > 0)


def filter_valid(df: DataFrame) -> DataFrame:
    return df.filter(is_valid())


def dedup_transactions(
    df: DataFrame,
    key: str = "transaction_id",
    newest_first: Sequence[str] = (SNAPSHOT, "transaction_ts", "amount"),
    where: Column | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the newest, ties broken by the remaining columns, so always the same one.

    The survivor is the maximum of the packed row (NULLs lowest). As a plain aggregate it is
    combined before the shuffle, so a key that holds a large part of all rows reaches its reducer
    as one row per map task; nothing is ever ranked within a key.

    ``where`` is the same as filtering first, but evaluated inside the aggregate: a filter would be
    pushed below the projection and parse every text a second time. Where all remaining columns are texts they
    travel as one, which sorts as they do. ``within`` names further columns of the key, by which the rows lie together
    already: they are not moved again.
    """
    order = [name for name in newest_first if name in df.columns]
    rest = [name for name in df.columns if name not in (key, *within, *order)]
    as_one = len(rest) > 1 and all(df.schema[name].dataType == T.StringType() for name in rest)
    packed = F.struct(*order, *([text.pack(rest).alias(_TEXTS)] if as_one else rest))
    if where is not None:
        packed = F.when(where, packed)
    survivors = df.filter(F.col(key).isNotNull()).groupBy(*within, key).agg(F.max(packed).alias("row"))
    survivors = survivors.filter(F.col("row").isNotNull()).select(*within, key, "row.*")
    if as_one:
        survivors = text.unpack(survivors, _TEXTS, rest)
    return survivors.select(*df.columns)


def dedup_repeats(
    df: DataFrame,
    key: str = "transaction_id",
    newest_first: Sequence[str] = (SNAPSHOT, "transaction_ts", "amount"),
    where: Column | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """The rows of ``dedup_transactions``; only rows whose key occurs more than once are shuffled, if those keys are few.

    Keys are counted first, in a pass that reads and shuffles nothing else. Where the repeated ones fit a
    broadcast, all other rows stay in place, however many; otherwise this is ``dedup_transactions``.
    ``df`` is read up to three times: for tables on disk whose keys can be read by themselves.
    """
    counts = df.select(key).filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counts.filter("n > 1").select(key), "repeated-keys", measured=True)
    if not fits_broadcast(repeated, broadcast_bytes):
        return dedup_transactions(df, key, newest_first, where)
    keys = F.broadcast(repeated.df)
    several = dedup_transactions(df.join(keys, key, "left_semi"), key, newest_first, where)
    single = df.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")
    if where is not None:
        # A row or none: a filter would be pushed below the projection and parse every text a second time.
        row = F.struct(*df.columns)
        single = single.select(F.explode(F.when(where, F.array(row))).alias("row")).select("row.*")
    return single.unionByName(several)


def enrich(df: DataFrame) -> DataFrame:
    """Clean names, calendar parts, size class and category group."""
    return df.withColumns(
        {
            "transaction_date": F.to_date("transaction_ts"),
            "vendor_name_clean": text.normalize_vendor(F.col("vendor_name")),
            "agency_name_clean": text.normalize_agency(F.col("agency_name")),
        }
    ).transform(derive)


def derive(df: DataFrame) -> DataFrame:
    """What follows from date, amount and category of a clean row: it need not travel with the row."""
    date = F.col("transaction_date")
    return (
        df.withColumns(
            {
                "year": F.year(date),
                "month": F.month(date),
                "day_of_week": F.dayofweek(date),
                "amount_bucket": money.amount_bucket(F.col("amount")),
                "category_group": text.category_group(F.col("mcc_description")),
            }
        )
        .withColumns(
            {
                "yyyymm": dates.yyyymm(F.col("year"), F.col("month")),
                "is_weekend": dates.is_weekend(F.col("day_of_week")),
            }
        )
    )


# The raw texts, last in the survivor rule, and what they become in silver; gold needs none of them.
_RAW_TEXTS = ["transaction_date_raw", "amount_raw", "description"]


def build_silver(bronze: DataFrame, columns: Sequence[str] = SILVER_COLUMNS) -> DataFrame:
    """Clean transactions, 19 columns, or those asked for.

    Only amount and timestamp are worked out for every raw row (validity and the survivor rule need
    them); everything else is derived after the one shuffle, on survivors only. Raw texts that are not
    asked for stay behind, but for those that decide between rows before one that is: the survivor is the
    maximum of the row, so what comes after the last column asked for changes none of the others.
    """
    wanted = max((at for at, name in enumerate(_RAW_TEXTS) if name in columns), default=-1)
    return (
        project_raw(bronze)
        .transform(type_money_and_time)
        .drop(*_RAW_TEXTS[wanted + 1 :])
        .transform(dedup_transactions, where=is_valid())
        .transform(enrich)
        .select(*columns)
    )


# What gold needs of silver.
GOLD_INPUT = [
    "transaction_id", "transaction_date", "amount", "year", "month", "vendor_name_clean", "agency_name_clean",
    "mcc_description", "category_group",
]
