"""Fill-in-the-middle: texts cut at line ends and reordered, as one pipeline of Arrow kernels per batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallystone.llm.arrow_text import slices
from tallystone.llm.workers import map_in_arrow

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
# Per cent of the texts that are transformed, and of those the share with the suffix in front.
RATE = 100
SPM_RATE = 50

_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(id_column: str = "doc_id", seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 per id: the first digits of a hash of seed and id, eight at a time."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def _remainder(numbers: pa.Array, divisor: pa.Array | int) -> pa.Array:
    """Kernels divide towards zero; the numbers are not negative."""
    return pc.subtract(numbers, pc.multiply(pc.divide(numbers, divisor), divisor))


def _offsets(sizes: pa.Array) -> pa.Array:
    ends = pc.cumulative_sum(pc.cast(sizes, pa.int32()))
    return pa.concat_arrays([pa.array([0], pa.int32()), ends])


def _lists(sizes: pa.Array, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(_offsets(sizes), values)


def _units(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The texts' lines with their line ends, each line's text, and the number of lines per text."""
    split = pc.split_pattern(texts, "\n")
    parts, parent = pc.list_flatten(split), pc.list_parent_indices(split)
    sizes = pc.cast(pc.list_value_length(split), pa.int64())
    starts = pc.cast(pc.list_parent_indices(split), pa.int64())
    ordinal = pc.subtract(_range(len(parts)), pc.take(_first(sizes), starts))
    # Behind every part but a text's last there was a line end; a last part that is empty is no line.
    is_last = pc.equal(ordinal, pc.subtract(pc.take(sizes, starts), 1))
    units = pc.binary_join_element_wise(parts, pc.if_else(is_last, "", "\n"), "")
    is_unit = pc.invert(pc.and_(is_last, pc.equal(parts, "")))
    ends_open = pc.not_equal(pc.utf8_slice_codeunits(texts, start=-1), "\n")
    filled = pc.and_(ends_open, pc.not_equal(texts, ""))
    n = pc.subtract(sizes, pc.if_else(filled, pa.scalar(0, pa.int64()), pa.scalar(1, pa.int64())))
    return units.filter(is_unit), parent.filter(is_unit), n


def _range(n: int) -> pa.Array:
    return pa.array(np.arange(n))


def _first(sizes: pa.Array) -> pa.Array:
    """Where each list's values begin."""
    return pc.subtract(pc.cumulative_sum(sizes), sizes)


def _pieces(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Number of lines, and prefix, middle and suffix of every text."""
    units, parent, n = _units(texts)
    spots = pc.add(n, 1)
    a, b = _remainder(h1, spots), _remainder(h2, spots)
    low, high = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    ordinal = pc.subtract(_range(len(units)), pc.take(_first(n), parent))
    in_prefix, in_suffix = pc.less(ordinal, pc.take(low, parent)), pc.greater_equal(ordinal, pc.take(high, parent))
    roles = [
        (low, in_prefix),
        (pc.subtract(high, low), pc.invert(pc.or_(in_prefix, in_suffix))),
        (pc.subtract(n, high), pc.and_(in_suffix, pc.invert(in_prefix))),
    ]
    return n, [pc.binary_join(_lists(sizes, units.filter(mask)), "") for sizes, mask in roles]


def _transform(batch: pa.RecordBatch, rate: int, spm_rate: int) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column(1), "")
    h1, h2, h3, h4 = (batch.column(i) for i in range(2, 6))
    n, (prefix, middle, suffix) = _pieces(texts, h1, h2)
    plain = pc.equal(texts, "")
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    plain = pc.or_(plain, pc.greater_equal(_remainder(h3, 100), rate))
    form = pc.if_else(plain, "plain", pc.if_else(pc.less(_remainder(h4, 100), spm_rate), "spm", "psm"))
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    output = pc.if_else(plain, texts, pc.if_else(pc.equal(form, "spm"), spm, psm))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x), pa.int64())) for x in (prefix, middle)]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return pa.RecordBatch.from_arrays([batch.column(0), n, form, *chars, output], names=names)


def fill_in_middle(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row.

    A text's ``n`` units are its lines with their line ends. Two cuts between units, drawn from the id,
    give prefix, middle and suffix. ``psm`` puts them down as prefix, suffix, middle, ``spm`` as suffix,
    prefix, middle, each behind its mark. A text stays ``plain`` if it is empty or null, if it holds a
    mark, or if the draw leaves it out; lengths are then null. A null id draws like the word "null" and
    stays null; repeated rows give equal rows; other columns are not read.
    """
    texts = F.col(text_column).cast("string").alias("text")
    rows = df.select(F.col(id_column).cast("bigint").alias("doc_id"), texts)
    rows = rows.select("doc_id", "text", *draws("doc_id", seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                yield _transform(part, rate, spm_rate)

    return map_in_arrow(rows, run, _SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. The marks occur once each in a transformed output."""
    between = lambda a, b: F.substring_index(F.substring_index(output, a, -1), b, 1)
    psm = F.concat(between(PREFIX, SUFFIX), F.substring_index(output, MIDDLE, -1), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), F.substring_index(output, MIDDLE, -1), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
