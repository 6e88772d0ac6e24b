"""Words, shingles and their 64-bit hashes, computed over whole byte arrays at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallystone.llm.arrow_text import IS_WORD_BYTE, Chunk, chunks
from tallystone.llm.workers import forgets

_random = np.random.Generator(np.random.PCG64(20_240_229))
_BYTE_VALUE = _random.integers(0, 2**64, 256, dtype=np.uint64)
# The polynomial's base is odd, so it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}
forgets(_powers.clear)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes, and so all other letters, as they are."""
    return _LOWER[data]


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64, kept for the task's next call."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, 1 << 19)
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[base] = table if size <= 1 << 20 else table[: 1 << 20].copy()
    return table[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits; one to one."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and per row the number of words before it.

    Rows lie next to each other without a separator; a word never crosses a row's bound.
    """
    if len(data) == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(bounds), np.int64)
    inside = IS_WORD_BYTE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    ends[tails] = inside[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans, from one running sum over all bytes."""
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _power_table(_BASE, len(data)), out=running[1:])
    return mix((running[ends] - running[starts]) * _power_table(_INVERSE, len(data))[starts])


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` successive words, and where each row's begin (one more bound than rows).

    A row with fewer words is one shingle of all its words; a row without words has none.
    """
    counts = np.diff(firsts)
    numbers = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(numbers)])
    total = int(bounds[-1])
    if total == 0:
        return np.empty(0, np.uint64), bounds
    rows = np.repeat(np.arange(len(counts)), numbers)
    at = firsts[:-1][rows] + np.arange(total) - bounds[:-1][rows]
    length = np.minimum(counts, size)[rows]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    multipliers = _power_table(_INVERSE, size + 1)
    sums = length.astype(np.uint64) * _BYTE_VALUE[0]
    whole = bool((length == size).all())
    for j in range(size):
        term = padded[at + j] * multipliers[j + 1]
        sums += term if whole else np.where(j < length, term, np.uint64(0))
    return mix(sums), bounds


def hashed_words(chunk: Chunk, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk and per row the number of words before it."""
    data = lower_ascii(chunk.data) if lower else chunk.data
    starts, ends, firsts = word_spans(data, chunk.bounds)
    return hash_spans(data, starts, ends), firsts


def rows_of_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of whole rows: first row, word hashes, and per row the number of words before it.

    A row that came in several chunks is put together again from its word hashes.
    """
    parts: list[np.ndarray] = []
    for chunk in chunks(column):
        words, firsts = hashed_words(chunk)
        if parts or not chunk.last:
            parts.append(words)
            if chunk.last:
                words = np.concatenate(parts)
                parts = []
                yield chunk.first, words, np.array([0, len(words)])
        else:
            yield chunk.first, words, firsts
