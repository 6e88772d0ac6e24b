"""Packing documents into token sequences of a fixed capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallystone.llm.encoding import encoder
from tallystone.llm.workers import map_in_arrow
from tallystone.sources.tables import stage

CAPACITY = 4096
# Id written behind every document.
SEPARATOR = 1
# Bins a task keeps open; each costs a few bytes.
OPEN_BINS = 4096
# Pieces one task packs. Larger tasks leave fewer bins open at their end; this many leave under 0.5 %.
PIECES_PER_TASK = 32_768

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(
    df: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
    with_ids: bool = False,
) -> DataFrame:
    """Encode every whole text, append the separator, and cut it into pieces of at most ``capacity`` ids.

    A null text is an empty one, so it is one piece holding the separator alone. ``ids_crc32`` is the
    CRC-32 of the piece's ids as little-endian unsigned 32-bit numbers; ``with_ids`` adds the ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([separator], np.uint32)
        for batch in batches:
            rows, pieces, starts, sizes, sums, kept = [], [], [], [], [], []
            parts: list[np.ndarray] = []
            for first, ids, bounds, last in encoder(vocabulary).rows(batch.column(1)):
                for i in range(len(bounds) - 1):
                    parts.append(ids[bounds[i] : bounds[i + 1]])
                    if not last:
                        continue
                    whole = np.concatenate([*parts, end]).astype("<u4", copy=False)
                    parts = []
                    for piece, start in enumerate(range(0, len(whole), capacity)):
                        held = whole[start : start + capacity]
                        rows.append(first + i)
                        pieces.append(piece)
                        starts.append(start)
                        sizes.append(len(held))
                        sums.append(zlib.crc32(held))
                        if with_ids:
                            kept.append(held.astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (starts, sizes, sums)]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return map_in_arrow(rows, cut, _PIECE + (", ids array<int>" if with_ids else ""))


class OpenBins:
    """Bounded-space best fit: bit f of a bitset tells whether an open bin has f free places."""

    def __init__(self, capacity: int, most_open: int, first_bin: int):
        self.capacity, self.most_open, self.next_bin = capacity, most_open, first_bin
        self._free_bits = 0
        self._bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._open = 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for the next piece: the fullest open bin that it fits in, else a new bin."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece of {length} does not fit a capacity of {self.capacity}")
        fitting = self._free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            if self._open == self.most_open:  # close the fullest
                self._take((self._free_bits & -self._free_bits).bit_length() - 1)
            chosen, free = self.next_bin, self.capacity
            self.next_bin += 1
        left = free - length
        if left:
            self._bins[left].append(chosen)
            self._free_bits |= 1 << left
            self._open += 1
        return chosen, self.capacity - free

    def _take(self, free: int) -> int:
        bins = self._bins[free]
        chosen = bins.pop()
        if not bins:
            self._free_bits &= ~(1 << free)
        self._open -= 1
        return chosen


def place_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, pieces_per_task: int = PIECES_PER_TASK
) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: which sequence holds a piece, and from which place on.

    Every task packs an equal share of the pieces in a shuffled but repeatable order, by online best
    fit with a bounded number of open bins. Pieces are dealt out evenly, not by key, so neither a
    long document nor a document id that occurs often makes a large task. Only the rows without ids
    are shuffled. ``pieces`` is read twice: pass a written table.
    """
    tasks = max(1, ceil(pieces.count() / pieces_per_task))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            placed = [bins.place(x) for x in batch.column("length").to_pylist()]
            arrays = [*batch.columns, pa.array([x[0] for x in placed], pa.int64())]
            arrays.append(pa.array([x[1] for x in placed], pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "sequence_id", "offset"])

    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = pieces.repartition(tasks).sortWithinPartitions(order, "doc_id", "piece", "start", "length", "ids_crc32")
    return map_in_arrow(dealt, pack, _PIECE + ", sequence_id bigint, offset bigint")


def pack_documents(
    df: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Pack all documents; one row per piece with its place.

    Null and empty texts are one piece of one id. Repeated rows are packed once each. A null id stays
    null. An empty table gives an empty result. Other columns are not read. The pieces, without their
    ids, are written to the shared folder, so a lost executor costs no second encoding.
    """
    pieces = stage(cut_pieces(df, vocabulary, id_column, text_column, capacity), "pieces").df
    return place_pieces(pieces, capacity)


def sequences(pieces_with_ids: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the packed sequences themselves, at most ``capacity`` ids each.

    Needs ids that are unique per document; pieces come from ``cut_pieces(..., with_ids=True)``.
    """
    joined = pieces_with_ids.select("doc_id", "piece", "ids").join(placed, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    grouped = joined.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
