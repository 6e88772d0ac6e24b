"""Finding logical fields under varying header names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallystone.functions.rules import FIELD_ALIASES, OTHER_CATEGORY, REQUIRED_FIELDS


def resolve_column(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """Actual spelling of the first candidate that is present, ignoring case.

    Of columns that differ only in case the first one counts.
    """
    present = list(columns)
    wanted = [c.lower() for c in candidates]
    matching = [name for name in present if name.lower() in wanted]
    return min(matching, key=lambda name: (wanted.index(name.lower()), present.index(name)), default=None)


def resolve_fields(
    columns: Sequence[str], aliases: Mapping[str, Sequence[str]] = FIELD_ALIASES
) -> dict[str, str | None]:
    return {field: resolve_column(columns, candidates) for field, candidates in aliases.items()}


def missing(resolved: Mapping[str, str | None], required: Sequence[str] = REQUIRED_FIELDS) -> list[str]:
    """Required fields without a column."""
    return [field for field in required if resolved.get(field) is None]


def require_fields(
    resolved: Mapping[str, str | None], columns: Sequence[str], required: Sequence[str] = REQUIRED_FIELDS
) -> None:
    """Raise one error naming every missing field and what was there instead."""
    absent = missing(resolved, required)
    if absent:
        raise ValueError(f"missing required fields {absent}; columns present: {list(columns)}")


def quoted(name: str) -> Column:
    """Column by exact name, also when the header holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def optional_field(name: str | None) -> Column:
    """The named column as string, or a typed NULL when it is absent."""
    return (F.lit(None) if name is None else quoted(name)).cast("string")


def gold_columns(df: DataFrame, other: str = OTHER_CATEGORY, carried: Sequence[str] = ()) -> DataFrame:
    """Bring a cleaned table to the column names the gold layer works on.

    Cleaned vendor and agency names are preferred over raw ones. Without a category group all
    rows get ``other``; without a merchant category the category group stands in for it. Columns that are
    ``carried`` come after those.
    """
    chosen = {
        "transaction_id": resolve_column(df.columns, ["transaction_id"]),
        "transaction_date": resolve_column(df.columns, ["transaction_date"]),
        "amount": resolve_column(df.columns, ["amount"]),
        "year": resolve_column(df.columns, ["year"]),
        "month": resolve_column(df.columns, ["month"]),
        "vendor_name": resolve_column(df.columns, ["vendor_name_clean", "vendor_name"]),
        "agency_name": resolve_column(df.columns, ["agency_name_clean", "agency_name"]),
    }
    require_fields(chosen, df.columns, list(chosen))
    group_name = resolve_column(df.columns, ["category_group"])
    group = F.lit(other) if group_name is None else quoted(group_name)
    category_name = resolve_column(df.columns, ["mcc_description"])
    category = group if category_name is None else quoted(category_name)
    return df.select(
        *[quoted(name).alias(field) for field, name in chosen.items()],
        category.alias("merchant_category"),
        group.alias("category_group"),
        *[quoted(name) for name in carried],
    )
