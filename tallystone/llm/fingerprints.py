"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallystone.llm.words import mix
from tallystone.llm.workers import map_in_arrow
from tallystone.sources.tables import stage

# A paragraph's wide vector: four lanes added modulo 2**64, which alone decide equality; a count of its
# sentences and CELLS sums over them, all modulo 2**32, from which the difference is estimated.
LANES = 4
CELLS = 80
_BYTES = 8 * LANES + 4 + 4 * CELLS

_PIECE_END = re.compile(r"(?<=[.!?])\s+")
# A piece without sentence ends is cut after so many characters.
_PIECE_CHARS = 400
# Cells hold sixteenths.
_PARTS = 16.0
# Sentences worked on at once.
_BLOCK = 1024
# Added to a sentence's hash, one for every two cells.
_SALTS = mix(np.arange(1, CELLS // 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _cells(hashes: np.ndarray) -> np.ndarray:
    """Per cell the sum of the sentences' Cauchy numbers, each drawn by the sentence's hash and the cell."""
    total = np.zeros(CELLS, np.int64)
    distinct, times = np.unique(hashes, return_counts=True)
    for at in range(0, len(distinct), _BLOCK):
        drawn = mix(distinct[at : at + _BLOCK, None] + _SALTS).view(np.uint32)
        numbers = np.rint(np.tan(np.pi * ((drawn + 0.5) / 2**32 - 0.5)) * _PARTS).astype(np.int64)
        total += times[at : at + _BLOCK] @ numbers
    return total.astype(np.uint32)


class Fingerprint:
    """The sum of the paragraphs' vectors: order does not matter, paragraphs can be added and taken away.

    Paragraphs are lines that are not blank, without the blanks around them. For likeness every
    paragraph also adds its sentences, repeats included, to the count and to all cells: a number drawn
    from a Cauchy distribution to each cell. The difference of two such sums is as wide as the number of
    sentences, repeats included, that only one of the two has; so its median tells that number, whether
    it is made up of many sentences or of one that is repeated, and however many there are.
    """

    __slots__ = ("lanes", "count", "cells")

    def __init__(self, lanes: np.ndarray | None = None, count: int = 0, cells: np.ndarray | None = None):
        self.lanes = np.zeros(LANES, np.uint64) if lanes is None else lanes
        self.count = count
        self.cells = np.zeros(CELLS, np.uint32) if cells is None else cells

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        paragraphs = [p for p in (line.strip() for line in text.split("\n")) if p]
        if not paragraphs:
            return cls()
        raw = [p.encode("utf-8", "surrogatepass") for p in paragraphs]
        digests = b"".join([hashlib.blake2b(p, digest_size=8 * LANES).digest() for p in raw])
        lanes = np.frombuffer(digests, np.uint64).reshape(-1, LANES).sum(axis=0, dtype=np.uint64)
        pieces = [s for p in paragraphs for s in _sentences(p)]
        short = b"".join([hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest() for s in pieces])
        return cls(lanes, len(pieces), _cells(np.frombuffer(short, np.uint64)))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.lanes + other.lanes, (self.count + other.count) % 2**32, self.cells + other.cells)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.lanes - other.lanes, (self.count - other.count) % 2**32, self.cells - other.cells)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.lanes.tobytes() == other.lanes.tobytes()

    __hash__ = None

    def to_bytes(self) -> bytes:
        return self.lanes.astype("<u8").tobytes() + self.count.to_bytes(4, "little") + self.cells.astype("<u4").tobytes()

    def hex(self) -> str:
        return self.to_bytes().hex()

    @classmethod
    def from_hex(cls, text: str) -> Fingerprint:
        raw = bytes.fromhex(text)
        if len(raw) != _BYTES:
            raise ValueError(f"a fingerprint has {_BYTES} bytes, not {len(raw)}")
        lanes = np.frombuffer(raw[: 8 * LANES], "<u8").astype(np.uint64)
        at = 8 * LANES
        return cls(lanes, int.from_bytes(raw[at : at + 4], "little"), np.frombuffer(raw[at + 4 :], "<u4").astype(np.uint32))

    def likeness(self, other: Fingerprint) -> float:
        """Estimated share of common sentences in all of both, repeats included, 0 to 1; 1 only for equal fingerprints.

        Exact would be the sum of each sentence's smaller count over the sum of its larger one. The
        number of differing sentences is estimated with a standard error of about 18 %, whatever its
        size, and is never less than the two counts differ or more than their sum.
        """
        if self == other:
            return 1.0
        both = self.count + other.count
        apart = np.abs((self.cells - other.cells).view(np.int32).astype(np.float64))
        difference = min(max(float(np.median(apart)) / _PARTS, abs(self.count - other.count), 1.0), both)
        return (both - difference) / (both + difference) if both else 0.0


def _sentences(paragraph: str) -> list[str]:
    pieces = _PIECE_END.split(paragraph)
    if max(map(len, pieces)) <= _PIECE_CHARS:
        return pieces
    return [p[i : i + _PIECE_CHARS] for p in pieces for i in range(0, max(len(p), 1), _PIECE_CHARS)]


def _edit(text: str, fingerprint: Fingerprint, following: str) -> tuple[str, Fingerprint]:
    """The text with its last quarter replaced by as much of the beginning of the next, and its fingerprint.

    Only the paragraphs from the one that is cut on are taken away and added; the others stay.
    """
    quarter = len(text) // 4
    keep = len(text) - quarter
    edited = text[:keep] + following[:quarter]
    start = text.rfind("\n", 0, keep) + 1
    return edited, fingerprint - Fingerprint.of(text[start:]) + Fingerprint.of(edited[start:])


_RESULT = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.binary(),
    "fingerprint": pa.binary(),
    "edited_fingerprint": pa.binary(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _compared(doc_id: int | None, text: str, own: Fingerprint, following: str, after: Fingerprint) -> tuple:
    edited, changed = _edit(text, own, following)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest()
    return doc_id, len(text), digest, own.to_bytes(), changed.to_bytes(), own.likeness(changed), own.likeness(after)


def _batch(rows: list[tuple], extra: dict[str, list] | None = None) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_RESULT)
    arrays = [pa.array(c, t) for c, t in zip(columns, _RESULT.values(), strict=True)]
    names = list(_RESULT)
    for name, values in (extra or {}).items():
        names.append(name)
        arrays.append(pa.array(values, {"part": pa.int32(), "edge": pa.string(), "text": pa.string()}[name]))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def fingerprint_edits(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every whole text, of its edited text, and how like they and the next text's are.

    The next document is the one with the next id in ascending order (null first, equal ids in the order
    of their texts); after the last comes the first. Rows are range partitioned by id once and pass
    through a task in order; what a task cannot know, the successor of its last row, is the first row
    of the next task that has rows. So each task also hands out its first and last row, and these two
    rows per task are joined by task number.

    A null text is an empty one: 0 characters, the fingerprint of nothing. A single row is its own
    successor. Repeated rows follow one another. An empty table gives an empty result; other columns
    are not read.
    """
    rows = df.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: tuple[int | None, str, Fingerprint] | None = None
        nothing = (None,) * (len(_RESULT) - 1)
        for batch in batches:
            done, edges = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Fingerprint.of(text)
                if held is None:
                    edges.append((doc_id, "first", text))
                else:
                    done.append(_compared(*held, text, own))
                held = doc_id, text, own
            n = len(done)
            yield _batch(
                done + [(e[0], *nothing) for e in edges],
                {
                    "part": [part] * (n + len(edges)),
                    "edge": [None] * n + [e[1] for e in edges],
                    "text": [None] * n + [e[2] for e in edges],
                },
            )
        if held is not None:
            yield _batch([(held[0], *nothing)], {"part": [part], "edge": ["last"], "text": [held[1]]})

    passed = stage(map_in_arrow(ordered, follow, _SCHEMA + ", part int, edge string, text string"), "fingerprints").df
    firsts = passed.filter("edge = 'first'").select("part", F.col("text").alias("following"))
    # One number per task that had rows.
    numbers = firsts.select("part")
    successor = F.lead("part").over(Window.orderBy("part"))
    turn = numbers.withColumn("next_part", F.coalesce(successor, F.min("part").over(Window.partitionBy())))
    lasts = passed.filter("edge = 'last'").select("doc_id", "text", "part")
    pairs = lasts.join(turn, "part").drop("part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch(
                [
                    _compared(i, text, Fingerprint.of(text), following, Fingerprint.of(following))
                    for i, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                ]
            )

    closed = map_in_arrow(pairs.select("doc_id", "text", "following"), close, _SCHEMA)
    as_hex = {name: F.lower(F.hex(name)) for name in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return passed.filter("edge is null").select(*_RESULT).union(closed).withColumns(as_hex)
