"""Preference pairs of conversations as a prompt and two masked completions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as an array of (role, text).

    Turns with a null conversation or number have no place and are left out; a null role is ``user``, a
    null text empty. Repeated rows count once; several turns with one number stand by role and text. A
    conversation is one value, so it must fit a task; nothing larger is gathered.
    """
    rows = turns.select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    placed = rows.filter("conv_id is not null and turn is not null")
    ordered = F.array_sort(F.collect_set(F.struct("turn", "role", "text")))
    grouped = placed.groupBy("conv_id").agg(ordered.alias("turns"))
    return grouped.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def reply_pairs(talks: DataFrame) -> DataFrame:
    """``pair_id, chosen, rejected`` from conversations that hold an assistant turn.

    For tables without rejected conversations. Chosen is the conversation up to its last assistant turn.
    Rejected is the conversation up to one of its assistant turns, picked by a hash of the id, with
    another text in it: that of the next assistant turn (behind the last, the first), or, if there is
    only one, that of the turn before it, an echo; a lone turn is answered with nothing.
    """
    spots = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda i: i.isNotNull())
    found = talks.withColumn("_spots", spots).filter(F.size("_spots") > 0)
    pick = F.conv(F.substring(F.md5(F.col("conv_id").cast("string")), 1, 8), 16, 10).cast("bigint")
    found = found.withColumn("_pick", (F.pmod(pick, F.size("_spots")) + 1).cast("int"))
    found = found.withColumn("_at", F.element_at("_spots", F.col("_pick")))
    later = F.element_at("_spots", (F.col("_pick") % F.size("_spots") + 1).cast("int"))
    other = F.when(F.size("_spots") > 1, F.element_at("turns", later)["text"])
    other = other.when(F.col("_at") > 1, F.get("turns", F.col("_at") - 2)["text"]).otherwise(F.lit(""))
    reply = F.array(F.struct(F.lit("assistant").alias("role"), other.alias("text")))
    return found.select(
        F.col("conv_id").alias("pair_id"),
        F.slice("turns", F.lit(1), F.element_at("_spots", -1)).alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), F.col("_at") - 1), reply).alias("rejected"),
    )


def _rendered(turns: Column) -> Column:
    shown = F.transform(turns, lambda t: F.concat(F.lit(TURN_START), t["role"], F.lit("\n"), t["text"], F.lit(TURN_END + "\n")))
    return F.array_join(shown, "")


def _spans(turns: Column) -> Column:
    """Character ranges ``from-to`` (from 0, end excluded) to learn from: assistant texts and their end marks."""
    frame = len(TURN_START) + 1
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.lit(frame) + F.length(t["role"])
        end = start + F.length(t["text"]) + F.lit(len(TURN_END))
        span = F.concat(start.cast("string"), F.lit("-"), end.cast("string"))
        spans = F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((end + F.lit(1)).alias("at"), spans.alias("spans"))

    return F.array_join(F.aggregate(turns, empty, add, lambda state: state["spans"]), ",")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """``pair_id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans``.

    ``pairs`` has ``pair_id`` and two arrays of (role, text), ``chosen`` and ``rejected``; null arrays are
    empty. The longest common prefix of whole turns is rendered once, as the prompt; what is left of
    either is its completion. The spans mark the characters of a completion that count for the loss:
    assistant texts with their end marks, not other roles, not headers. Equal conversations are all
    prompt, with two empty completions and no spans. Repeated pairs give repeated rows.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.select("pair_id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    differs = F.array_position(F.slice(F.zip_with("c", "r", lambda x, y: x.eqNullSafe(y)), F.lit(1), shorter), False)
    both = both.withColumn("n", F.when(differs > 0, (differs - 1).cast("int")).otherwise(shorter))
    rest = lambda name: F.slice(name, F.col("n") + 1, F.size(name))
    return both.select(
        "pair_id",
        F.col("n").alias("prompt_turns"),
        _rendered(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _rendered(rest("c")).alias("chosen"),
        _rendered(rest("r")).alias("rejected"),
        _spans(rest("c")).alias("chosen_spans"),
        _spans(rest("r")).alias("rejected_spans"),
    )
