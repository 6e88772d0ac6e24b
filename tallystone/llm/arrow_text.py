"""Texts of an Arrow column as one byte array, handed out in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# UTF-8 bytes worked on at once: numpy's intermediate arrays take about 50 times as much.
CHUNK_BYTES = 1 << 19

_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_WORD_BYTE = np.ones(256, dtype=bool)
IS_WORD_BYTE[list(_SPACES)] = False


@dataclass(frozen=True)
class Chunk:
    """Bytes of the rows ``first .. first + len(bounds) - 2``; row i is ``data[bounds[i]:bounds[i + 1]]``.

    A row longer than a chunk arrives as several chunks of that one row, ``last`` marking its end.
    """

    first: int
    data: np.ndarray
    bounds: np.ndarray
    last: bool = True


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row bounds of a string column without copying; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), bounds


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """All rows in order, at most about ``limit`` bytes at a time.

    A longer row is cut behind ASCII white space, so that no word is torn; only a single word
    longer than the limit makes a larger chunk.
    """
    data, bounds = text_buffers(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        if end > row:
            end = min(end, rows)
            yield Chunk(row, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
            row = end
            continue
        at, stop = int(bounds[row]), int(bounds[row + 1])
        while at < stop:
            cut = _behind_space(data, min(at + limit, stop), stop)
            yield Chunk(row, data[at:cut], np.array([0, cut - at]), last=cut == stop)
            at = cut
        row += 1


def _behind_space(data: np.ndarray, at: int, stop: int, step: int = 4096) -> int:
    """The first position from ``at`` on that follows white space, or ``stop``."""
    while at < stop:
        spaces = np.flatnonzero(~IS_WORD_BYTE[data[at - 1 : min(at - 1 + step, stop)]])
        if len(spaces):
            return at + int(spaces[0])
        at += step
    return stop


def slices(batch: pa.RecordBatch, column: int, limit: int = 16 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows with at most about ``limit`` bytes of text; a longer row comes alone."""
    _, bounds = text_buffers(batch.column(column))
    row = 0
    while row < len(batch):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1)
        yield batch.slice(row, end - row)
        row = end
