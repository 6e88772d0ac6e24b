"""Mixing sources to target weights, in whole and fractional repetitions. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystone.operators.lookup import attach
from tallystone.operators.ranking import row_numbers
from tallystone.sources.columns import quoted
from tallystone.sources.tables import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 7

WORD = r"[^\x20\x09-\x0D]+"
# Documents of a source stand in the order of a 60-bit hash, read 12 bits at a time.
_DIGIT_BITS = 12
_DIGITS = 2


def word_count(text: str) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))).cast("bigint")


def sampling_order(id_column: str, seed: int = SEED) -> Column:
    """A document's place in its source's order: 60 bits of an md5, the same in every run and engine."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """Add ``target`` to ``source, source_size`` (one row per source): capped water-filling.

    Sources weigh ``weights`` in turn, by code point, null last. All targets together are ``share``
    times all sizes, in proportion to the weights; a source whose part exceeds ``max_epochs`` times its
    size is clamped there, and the excess goes to the others by weight, until none exceeds its cap.
    Each round is one small aggregate over the sources; a clamped source stays clamped, so the rounds
    are at most as many as the sources, in practice a handful. ``sizes`` is read repeatedly: pass a
    written table.
    """
    ranked = row_numbers(sizes, [F.col("source").asc_nulls_last()], "_rank")
    turn = ((F.col("_rank") - 1) % len(weights) + 1).cast("int")
    weighed = ranked.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("_weight"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("_cap"),
    )
    weighed = stage(weighed, "source-weights").df
    level = 0.0
    while True:
        clamped = (F.col("_cap") <= F.col("_weight") * F.lit(level)) & F.lit(level > 0)
        row = weighed.agg(
            (F.sum("source_size") * F.lit(share)).alias("all"),
            F.sum(F.when(clamped, F.col("_cap")).otherwise(0.0)).alias("held"),
            F.sum(F.when(clamped, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        if not row["weight"]:  # no source, or all of them at their caps
            filled = F.col("_cap")
            break
        raised = max((row["all"] - row["held"]) / row["weight"], 0.0)
        if raised <= level or raised == 0.0:
            filled = F.least(F.col("_weight") * F.lit(level), F.col("_cap"))
            break
        level = raised
    return weighed.select("source", "source_size", F.round(filled, 6).alias("target"))


def mixing_plan(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """Per source: its target, how often all of it is taken, and where the last, partial round ends.

    ``rows`` holds ``source, size, place`` of every document and is read several times: pass a written
    table. The partial round takes documents in the order of ``place`` up to ``cut_place``; of the
    documents at that place (one, unless ids repeat), which have ``cut_size`` words together, it takes
    ``cut_words``. The cut is found digit by digit of the place: sums per source and digit, combined
    before the shuffle, so a source with a third of all rows is no larger a group than another.
    """
    sizes = stage(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes").df
    goal = F.round("target").cast("bigint")
    targets = source_targets(sizes, weights, share, max_epochs).withColumn("_goal", goal)
    whole = F.when(F.col("source_size") > 0, F.expr("_goal div source_size")).otherwise(F.lit(0).cast("bigint"))
    targets = targets.withColumn("epochs", whole)
    targets = targets.withColumn("_rest", F.col("_goal") - F.col("epochs") * F.col("source_size"))
    targets = stage(targets.drop("_goal"), "source-targets").df

    open_part = targets.filter("_rest > 0").select("source", F.col("_rest").alias("_left"), F.lit(0).cast("bigint").alias("_at"))
    shift = 60
    for _ in range(_DIGITS):
        held = _within(rows, open_part, shift)
        shift -= _DIGIT_BITS
        open_part = stage(_cut(held.withColumn("_at", F.shiftright("place", shift))), "cut").df
    found = _cut(_within(rows, open_part, shift).withColumn("_at", F.col("place")))
    cuts = found.select(
        F.col("source").alias("_source"),
        F.col("_at").alias("cut_place"),
        F.col("_left").alias("cut_words"),
        F.col("_size").alias("cut_size"),
    )
    return stage(
        targets.join(cuts, targets["source"].eqNullSafe(cuts["_source"]), "left").drop("_source", "_rest"), "mixing-plan"
    ).df


def _within(rows: DataFrame, part: DataFrame, shift: int) -> DataFrame:
    """The rows whose place begins with their source's digits found so far."""
    part = part.select(F.col("source").alias("_source"), F.col("_at").alias("_found"), "_left")
    same = rows["source"].eqNullSafe(part["_source"]) & (F.shiftright(rows["place"], shift) == part["_found"])
    return rows.join(part, same).select(rows["source"], rows["size"], rows["place"], "_left")


def _cut(held: DataFrame) -> DataFrame:
    """Of each source the value of ``_at`` where the running total reaches ``_left``, and what is left there."""
    sums = held.groupBy("source", "_left", "_at").agg(F.sum("size").alias("_size"))
    running = F.sum("_size").over(Window.partitionBy("source").orderBy("_at")) - F.col("_size")
    left = F.col("_left") - F.col("_before")
    reached = sums.withColumn("_before", running).filter((left > 0) & (left <= F.col("_size")))
    return reached.select("source", left.alias("_left"), "_at", "_size")


def taken(size: str = "size", place: str = "place") -> Column:
    """Words that the mix takes of a document, repeats counted; needs the plan's columns beside it."""
    part = F.expr(f"{size} * cut_words div cut_size")
    partial = F.when(F.col(place) < F.col("cut_place"), F.col(size)).when(F.col(place) == F.col("cut_place"), part)
    return F.col("epochs") * F.col(size) + F.coalesce(partial, F.lit(0).cast("bigint"))


def _with_plan(df: DataFrame, plan: DataFrame, source: str) -> DataFrame:
    """Each row with its source's plan. Rows of a source that holds much of the table are not moved, however many sources there are."""
    key = lambda name: F.coalesce(F.concat(F.lit("="), quoted(name)), F.lit("null"))
    lookup = stage(plan.withColumn("_plan_key", key("source")).drop("source"), "mixing-lookup", measured=True)
    return attach(df.withColumn("_plan_key", key(source)), lookup, "_plan_key", how="inner").drop("_plan_key")


def mix_sources(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row.

    Whole repetitions take every document of the source; the fractional one takes whole documents in
    a seeded order, and of the last one as many words as are missing, so a source meets its rounded
    target exactly. ``taken`` never exceeds ``max_epochs`` times the size.

    Null texts have 0 words. Null sources are one source, the last. Rows with equal ids have equal
    places; if the cut falls on them, they share its words in proportion to size. A null id has a place
    of its own. An empty table gives an empty result. Other columns are not read.
    """
    rows = df.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(text_column).alias("size"),
        sampling_order(id_column, seed).alias("place"),
    )
    rows = stage(rows, "mixing-rows").df
    joined = _with_plan(rows, mixing_plan(rows, weights, share, max_epochs), "source")
    return joined.select("doc_id", "size", "source_size", "target", taken().alias("taken"))


def mixed_documents(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself, with the columns of ``df``: a row for each repetition of a document.

    The one document per source at which the partial round ends gets a row with its first words.
    Documents without words are not in the mix.
    """
    # The row goes along whole, so its columns' names clash with none of those used here.
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(source_column).cast("string").alias("source"),
        word_count(text_column).alias("size"),
        sampling_order(id_column, seed).alias("place"),
    )
    plan = mixing_plan(stage(rows.drop("row"), "mixing-rows").df, weights, share, max_epochs)
    joined = _with_plan(rows, plan, "source").withColumn("taken", taken())
    whole = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0)).cast("int")
    words = F.concat(F.array_repeat("size", whole), F.array(F.col("taken") - whole * F.col("size")))
    repeated = joined.withColumn("words", F.explode(words)).filter("words > 0")
    pieces = F.regexp_extract_all(F.col("row")[text_column], F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") == F.col("size"), F.col("row")[text_column]).otherwise(cut)
    return repeated.select(F.col("row").withField(text_column, text).alias("row")).select("row.*")
