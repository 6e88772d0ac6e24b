"""Attaching a unique-key lookup table to a large, possibly skewed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystone.sources.tables import Staged, stage

# A lookup is broadcast whole up to this size.
BROADCAST_BYTES = 64 * 1024 * 1024
# Beyond it, a key counts as heavy when it holds at least 1/HEAVY_KEYS of all rows, so at most
# this many keys can be heavy, whatever the data.
HEAVY_KEYS = 20_000


def fits_broadcast(lookup: Staged, limit: int | None = None) -> bool:
    return lookup.bytes <= (BROADCAST_BYTES if limit is None else limit)


def attach(
    facts: DataFrame,
    lookup: Staged,
    key: str,
    how: str = "left",
    broadcast_bytes: int | None = None,
    heavy_keys: int | None = None,
    stage_facts: bool = False,
    rows_per_key: DataFrame | None = None,
) -> DataFrame:
    """Equi-join ``facts`` with a staged lookup that has one row per ``key``; ``how`` is left or inner.

    A lookup of known small size is broadcast and the facts are not shuffled at all. With a larger
    one, the facts' rows per key are counted first. If some keys are heavy, their few lookup rows
    are broadcast, so the rows of a hot key never meet in one task, and only the other rows are
    shuffled on the key. NULL keys match nothing and stay where they are as well. The split changes
    where rows go, never the result.

    Facts are read up to three times then: attach large lookups first and small ones on top, and
    let ``stage_facts`` write facts that are costly to derive. ``rows_per_key`` (``key, n``) spares counting
    where the numbers are known.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"attach supports left and inner joins, not {how!r}")
    if fits_broadcast(lookup, broadcast_bytes):
        return facts.join(F.broadcast(lookup.df), key, how)

    if stage_facts:
        facts = stage(facts, "facts").df
    per_key = rows_per_key
    if per_key is None:
        per_key = stage(facts.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "rows-per-key").df
    total = per_key.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * (HEAVY_KEYS if heavy_keys is None else heavy_keys) >= total
    if per_key.filter(is_heavy).isEmpty():
        return facts.join(lookup.df, key, how)

    heavy = F.broadcast(per_key.filter(is_heavy & F.col(key).isNotNull()).select(key))
    heavy_lookup = F.broadcast(lookup.df.join(heavy, key, "left_semi").withColumn("is_heavy", F.lit(True)))
    light_lookup = lookup.df.join(heavy, key, "left_anti")
    hot = facts.join(heavy_lookup, key, how)
    if how == "left":
        hot = hot.filter(F.col("is_heavy") | F.col(key).isNull())
    cold = (
        facts.filter(F.col(key).isNotNull())
        .join(heavy_lookup.select(key), key, "left_anti")
        .join(light_lookup, key, how)
    )
    return hot.drop("is_heavy").unionByName(cold)
