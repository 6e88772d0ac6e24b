"""Integrity of the star schema: unique keys, required columns, references. Violations are rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from tallystone.functions.rules import KEYS, REQUIRED_COLUMNS


@dataclass(frozen=True)
class Rules:
    """Constraints of one table; ``references`` maps a column to (dimension table, its column)."""

    keys: Sequence[Sequence[str]]
    required: Sequence[str] = ()
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)


_REFERENCES = {"agency_id": ("dim_agency", "agency_id"), "vendor_id": ("dim_vendor", "vendor_id")}


def _rules(table: str) -> Rules:
    required = REQUIRED_COLUMNS[table]
    refers = {c: to for c, to in _REFERENCES.items() if c in required and to[0] != table}
    return Rules(KEYS[table], required, refers)


STAR_RULES = {table: _rules(table) for table in KEYS}


def violations(name: str, tables: Mapping[str, DataFrame], rules: Rules, nulls_checked: bool = False) -> DataFrame:
    """Rows (table_name, rule, offenders), one per broken rule of one table; none when it is sound.

    Every check aggregates before it compares: keys are counted, NULLs are counted in one pass,
    references are compared as distinct ids. With ``nulls_checked`` that pass is left out. Ids are whole and dense
    numbers, so they are shuffled as bitmaps.
    """
    table = tables[name]
    checks = [
        _suspects(table, key)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .agg(F.count(F.lit(1)).alias("offenders"))
        .select(F.lit(f"unique {', '.join(key)}").alias("rule"), "offenders")
        for key in rules.keys
    ]
    if rules.required and not nulls_checked:
        counts = [F.count_if(F.col(c).isNull()).alias(c) for c in rules.required]
        checks.append(
            table.agg(*counts)
            .unpivot([], list(rules.required), "column", "offenders")
            .select(F.concat(F.lit("required "), "column").alias("rule"), "offenders")
        )
    for column, (dim, dim_column) in rules.references.items():
        checks.append(
            _unknown_ids(table, column, tables[dim], dim_column).select(
                F.lit(f"{column} references {dim}").alias("rule"), "offenders"
            )
        )
    return (
        reduce(DataFrame.unionByName, checks)
        .filter("offenders > 0")
        .select(F.lit(name).alias("table_name"), "rule", "offenders")
    )


def _is_whole(table: DataFrame, column: str) -> bool:
    return isinstance(table.schema[column].dataType, T.IntegralType)


def _suspects(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """The key's columns of rows among which repeats can be; all rows, unless the key is an id within something else.

    Such ids are marked in a bitmap per bucket of 32,768: a bucket with as many marks as rows has no repeat.
    Of the others only their numbers are broadcast.
    """
    *within, column = key
    if not within or not column.endswith("_id") or not _is_whole(table, column):
        return table.select(*key)
    rows = table.select(*key, F.bitmap_bucket_number(column).alias("_bucket"), F.bitmap_bit_position(column).alias("_bit"))
    buckets = rows.groupBy(*within, "_bucket").agg(
        F.count(F.lit(1)).alias("_rows"), F.bitmap_count(F.bitmap_construct_agg("_bit")).alias("_marks")
    )
    suspect = buckets.filter("_rows > _marks").select(*[F.col(name).alias(f"_{name}") for name in within], F.col("_bucket").alias("_suspect"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in within]
    return rows.join(F.broadcast(suspect), [*same, F.col("_bucket").eqNullSafe(F.col("_suspect"))], "left_semi").select(*key)


def _unknown_ids(table: DataFrame, column: str, dim: DataFrame, dim_column: str) -> DataFrame:
    """One row: how many different ids of the table the dimension lacks."""
    if not _is_whole(table, column) or not _is_whole(dim, dim_column):
        ids = table.filter(F.col(column).isNotNull()).select(column).distinct()
        unknown = ids.join(dim.select(F.col(dim_column).alias(column)), column, "left_anti")
        return unknown.agg(F.count(F.lit(1)).alias("offenders"))

    def marked(df, name):
        known = df.filter(F.col(name).isNotNull())
        placed = known.select(F.bitmap_bucket_number(name).alias("bucket"), F.bitmap_bit_position(name).alias("bit"))
        return placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("ids"))

    theirs = marked(dim, dim_column).withColumn("known", F.bitmap_count("ids"))
    both = marked(table, column).withColumn("known", F.lit(0).cast("bigint")).unionByName(theirs)
    united = both.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("ids")).alias("all"), F.sum("known").alias("known"))
    return united.agg(F.coalesce(F.sum(F.col("all") - F.col("known")), F.lit(0)).alias("offenders"))


def star_violations(tables: Mapping[str, DataFrame], nulls_checked: bool = False) -> DataFrame:
    """Violations of all tables of the star that are present."""
    found = [violations(name, tables, rules, nulls_checked) for name, rules in STAR_RULES.items() if name in tables]
    return reduce(DataFrame.unionByName, found)


def check_integrity(tables: Mapping[str, DataFrame], nulls_checked: bool = False) -> None:
    """Raise when any rule is broken."""
    broken = star_violations(tables, nulls_checked).collect()  # at most one row per rule
    if broken:
        found = "; ".join(f"{r.table_name}: {r.rule} ({r.offenders})" for r in broken)
        raise ValueError(f"integrity check failed: {found}")
