"""Connected components of a link table that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystone.sources.tables import stage


def connected_components(links: DataFrame, most_rounds: int | None = None) -> DataFrame:
    """``node, component`` for every node with a link; the component is its smallest node.

    With ``most_rounds`` it may stop early: then nodes with one component number are still connected, but
    not all connected nodes have one number.

    ``links`` has two bigint columns ``a, b``. Alternates large-star and small-star steps: each points
    neighbours at the smallest node known to them, so the number of steps grows with the logarithm of
    the component sizes, and a step never gathers a node's neighbours in one place (minimum, then
    join). Every step is written to the shared folder, which also keeps plans short. Links of a node
    with itself and links with a null end are ignored.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links").df
    state = _fingerprint(edges)
    rounds = 0
    while most_rounds is None or rounds < most_rounds:
        rounds += 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["c"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large, "large-star").df
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), "m")
        joined = large.join(least, large["a"] == least["c"])
        pairs = F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        edges = stage(joined.select(pairs.alias("p")).select("p.*").filter("a <> b").distinct(), "small-star").df
        before, state = state, _fingerprint(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    named = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
    return named.groupBy("node").agg(F.min("component").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
