"""Vendors whose names differ by misspellings only: rare letter groups find candidates, edit distance decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystone.sources.tables import stage

# Letters of a group; a single edit changes at most so many groups of a name.
GRAM = 3
# (letters a name has at least, edits it may be off), longest first; shorter names must be equal.
ALLOWED_EDITS = ((12, 2), (5, 1))


def allowed_edits(length: Column) -> Column:
    allowed = F
    for least, edits in ALLOWED_EDITS:
        allowed = allowed.when(length >= least, edits)
    return allowed.otherwise(0)


def _sorted_grams(name: Column) -> Column:
    """Groups of successive letters of the padded name, in their order."""
    padded = F.concat(F.lit("\x02" * (GRAM - 1)), name, F.lit("\x03" * (GRAM - 1)))
    plain = F.transform(F.sequence(F.lit(1), F.length(name) + GRAM - 1), lambda i: F.substring(padded, i, F.lit(GRAM)))
    return F.sort_array(plain)


def _numbered(grams: Column) -> Column:
    """A repeated group carries its number, from 0, so that sets keep count: equal ones lie together.

    ``grams`` has to be a column of the table below: an expression would be worked out again for every group.
    """
    return F.transform(grams, lambda x, i: F.concat(x, (i + 1 - F.array_position(grams, x)).cast("string")))


def _digits(name: str) -> Column:
    return F.regexp_replace(name, r"[^0-9]", "")


def candidate_pairs(names: DataFrame) -> DataFrame:
    """``a, b`` (a < b): all pairs of names within the allowed edits, and some others.

    Numbers are never misspelled: names with different digits are no candidates. Two names at most ``d``
    edits apart differ in at most ``GRAM * d`` groups, so they share one of the ``GRAM * d + 1`` rarest of
    either; only those are posted. Groups in one name alone are the rarest of all: they take their places,
    but are dropped as soon as they are counted.

    A group and the name's digits are told by a hash: equal hashes of others only add candidates, of which
    those with other digits go at the end. Written names take a small part of their size in memory, so no
    join here may be planned as a broadcast by the size of files.
    """
    known = names.select("name", F.length("name").alias("length")).withColumn("edits", allowed_edits(F.col("length")))
    # Digits and groups once per name, written, so that no later step works them out for every posting.
    taken = known.filter("edits > 0").withColumns({"digits": F.xxhash64(_digits("name")), "grams": _sorted_grams(F.col("name"))})
    taken = stage(taken, "grams-of-names").df
    postings = taken.select("name", "length", "edits", "digits", F.explode(_numbered(F.col("grams"))).alias("gram"))
    postings = stage(postings.withColumn("gram", F.xxhash64("digits", "gram")).drop("digits"), "name-grams").df
    counts = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    per_name = Window.partitionBy("name")  # as many rows as a name has letters
    alone = F.col("length") + (GRAM - 1) - F.count(F.lit(1)).over(per_name)
    place = alone + F.row_number().over(per_name.orderBy("holders", "gram"))
    prefix = postings.join(counts.hint("merge"), "gram").withColumn("place", place).filter(F.col("place") <= F.col("edits") * GRAM + 1)
    prefix = stage(prefix.select("gram", "name", "length", _digits("name").alias("digits")), "name-prefixes").df
    x = prefix.select("gram", F.col("name").alias("a"), F.col("length").alias("length_a"), F.col("digits").alias("digits_a"))
    y = prefix.select("gram", F.col("name").alias("b"), F.col("length").alias("length_b"), F.col("digits").alias("digits_b"))
    near = F.abs(F.col("length_a") - F.col("length_b")) <= allowed_edits(F.least("length_a", "length_b"))
    near = near & (F.col("a") < F.col("b")) & (F.col("digits_a") == F.col("digits_b"))
    return x.join(y.hint("merge"), "gram").filter(near).select("a", "b").distinct()


def misspellings(names: DataFrame) -> DataFrame:
    """``a, b, edits``: the pairs of names (column ``name``, each once) that the allowed edits connect directly."""
    limit = allowed_edits(F.least(F.length("a"), F.length("b")))
    found = candidate_pairs(names).withColumn("edits", F.levenshtein("a", "b", max(edits for _, edits in ALLOWED_EDITS)))
    return found.filter((F.col("edits") >= 0) & (F.col("edits") <= limit))


def connected(links: DataFrame) -> DataFrame:
    """``name, root`` for every name with a link; the root is the least name it is connected with.

    Every round points each name at the least root among its neighbours', and then at its root's root, so
    the number of rounds grows with the logarithm of the longest chain. Each is written to the shared folder.
    The names in them take far more room in memory than in files, hence merge joins.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "both-ways").df
    state = stage(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("name"), F.least("a", "least").alias("root")), "roots").df
    while True:
        neighbour = both.join(state.select(F.col("name").alias("b"), "root").hint("merge"), "b").groupBy(F.col("a").alias("name")).agg(F.min("root").alias("near"))
        lowered = state.join(neighbour.hint("merge"), "name").select("name", "root", F.least("root", "near").alias("low"))
        # A root may be told by any of its names that something lower is connected.
        told = lowered.groupBy(F.col("root").alias("_root")).agg(F.min("low").alias("told"))
        hooked = lowered.join(told.hint("merge"), F.col("low") == F.col("_root"), "left").select("name", "root", F.least("low", F.coalesce("told", "low")).alias("new"))
        hooked = stage(hooked, "roots").df
        moved = hooked.filter(F.col("new") != F.col("root")).isEmpty()
        state = hooked.select("name", F.col("new").alias("root"))
        if moved:
            return state


def vendor_groups(names: DataFrame) -> DataFrame:
    """``name, group_name, members`` for every name: misspellings of one vendor under its commonest spelling.

    ``names`` has ``name`` (each once, NULL and blank ones are dropped) and ``weight``, say the number of
    transactions. The name with the most weight stands for its group, ties by name. Chains are followed: two names of
    a group may be further apart than the allowed edits.
    """
    known = stage(names.filter(F.trim("name") != "").select("name", "weight"), "names").df
    roots = connected(stage(misspellings(known), "misspellings").df)
    placed = stage(known.join(roots.hint("merge"), "name", "left").withColumn("root", F.coalesce("root", "name")), "placed-names").df
    best = F.min_by("name", F.struct(-F.col("weight"), F.col("name")))
    groups = placed.groupBy("root").agg(best.alias("group_name"), F.count(F.lit(1)).alias("members"))
    return placed.join(groups.hint("merge"), "root").select("name", "group_name", "members")
