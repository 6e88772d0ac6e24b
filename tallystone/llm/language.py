"""Language identification with hyperdimensional letter n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystone.llm.arrow_text import chunks
from tallystone.llm.workers import forgets, map_in_arrow
from tallystone.sources.tables import stage

DIMENSIONS = 1024
# If prototypes are bundled from a sample only: documents that a language has of its own in it, all if it has fewer.
LEAST_ROWS = 200
UNKNOWN = "und"
# Cosine below which a text is in none of the learned languages, where too few texts of its size are known.
# Unrelated letters come to about 1 / 32 (one over the root of the dimensions).
MIN_SCORE = 0.05
# Else the bar is this share of the score that nearly all texts of the size reach.
_BAR_SHARE = 0.7
_BAR_QUANTILE = 0.001
_BAR_ROWS = 100
SEED = 11

# Bytes of text whose n-grams are counted together; rows of n-gram vectors bundled at once.
_CHUNK_BYTES = 1 << 19
_BLOCK = 2048
# Whole numbers keep the sums of prototypes the same in every order of addition.
_SCALE = float(1 << 20)

_letter_vectors: dict[int, np.ndarray] = {}
forgets(_letter_vectors.clear)
_is_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _is_letter
    if _is_letter is None:
        _is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _is_letter


def letter_vector(code: int) -> np.ndarray:
    """A letter's random vector of +1 and -1, the same everywhere; 0 is the edge of a word."""
    if code not in _letter_vectors:
        if len(_letter_vectors) > 8192:
            _letter_vectors.clear()
        random = np.random.Generator(np.random.PCG64([SEED, code]))
        _letter_vectors[code] = random.integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1
    return _letter_vectors[code]


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct letter trigrams (three code points each), and of every occurrence its text and trigram.

    Trigrams stay within words; both edges of a word count as a letter, so "to" gives _to and to_.
    """
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0)
    ends = np.cumsum([len(t) + 1 for t in texts])
    present = np.unique(codes)
    ranks = np.searchsorted(present, codes).astype(np.int64)
    padded = np.concatenate([[0], ranks, [0]])  # rank 0 is the edge: every text ends with one
    middle = np.flatnonzero(codes)
    size = len(present)
    keys = (padded[middle] * size + padded[middle + 1]) * size + padded[middle + 2]
    distinct, which = np.unique(keys, return_inverse=True)
    grams = present[np.stack([distinct // (size * size), distinct // size % size, distinct % size], axis=1)]
    return grams, np.searchsorted(ends, middle, side="right"), which


def _bundles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One hypervector per text, the sum of its trigrams' vectors, and the number of trigrams.

    A trigram's vector binds (multiplies) its letters' vectors, permuted by their position, so that
    "abc" and "cba" are unrelated.
    """
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    grams, rows, which = _trigrams(texts)
    if not len(which):
        return out, np.zeros(len(texts), np.int64)
    counts = np.bincount(rows * len(grams) + which, minlength=len(texts) * len(grams)).reshape(len(texts), -1)
    letters, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    plain = np.stack([letter_vector(int(c)) for c in letters])
    first, second = np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1)
    for block in range(0, len(grams), _BLOCK):
        a, b, c = at[block : block + _BLOCK].T
        vectors = first[a] * second[b] * plain[c]
        out += counts[:, block : block + _BLOCK].astype(np.float32) @ vectors.astype(np.float32)
    return out, counts.sum(axis=1)


def document_profiles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, one hypervector per row, number of trigrams per row) for groups of whole rows."""
    carried: tuple[np.ndarray, np.ndarray] | None = None
    for chunk in chunks(column, _CHUNK_BYTES):
        raw = chunk.data.tobytes()
        texts = [raw[a:b].decode("utf-8").lower() for a, b in zip(chunk.bounds[:-1], chunk.bounds[1:], strict=True)]
        vectors, numbers = _bundles(texts)
        if carried is not None:
            vectors, numbers = vectors + carried[0], numbers + carried[1]
        carried = None if chunk.last else (vectors, numbers)
        if chunk.last:
            yield chunk.first, vectors, numbers


def document_vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, one hypervector per row) for groups of whole rows; a row without letters is zero."""
    for first, vectors, _ in document_profiles(column):
        yield first, vectors


def sizes(vectors: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Rough number of different trigrams, as a power of two rounded down: what repeats counts little.

    A bundle's squared length is about the dimensions times the sum of the squared counts.
    """
    squares = np.square(vectors, dtype=np.float64).sum(axis=1) / DIMENSIONS
    different = np.divide(numbers.astype(float) ** 2, squares, out=np.ones(len(numbers)), where=squares > 0)
    return np.floor(np.log2(np.maximum(different, 1.0))).astype(np.int64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


@dataclass(frozen=True)
class Prototypes:
    """Languages in ascending order, and a unit vector each."""

    languages: list[str]
    vectors: np.ndarray

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        names, scores, _ = self.profile(column)
        return names, scores

    def profile(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores and sizes (see ``sizes``)."""
        names, scores, found = [UNKNOWN] * len(column), np.zeros(len(column)), np.zeros(len(column), np.int64)
        if not self.languages:
            return names, scores, found
        for first, vectors, numbers in document_profiles(column):
            likeness = np.round(_unit(vectors).astype(np.float64) @ self.vectors.T, 6)
            best = likeness.argmax(axis=1)
            found[first : first + len(vectors)] = sizes(vectors, numbers)
            for i in np.flatnonzero(np.abs(vectors).sum(axis=1) > 0).tolist():
                names[first + i] = self.languages[best[i]]
                scores[first + i] = min(max(likeness[i, best[i]], 0.0), 1.0)
        return names, scores, found


def _labelled(df: DataFrame, sample_rows: int | None, id_column: str, text_column: str, lang_column: str) -> DataFrame:
    """``text, lang`` of the labelled documents, or of a sample: from every language as many, so that none is lost as others grow."""
    rows = df.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        F.col(lang_column).cast("string").alias("lang"),
    ).filter("lang is not null and text is not null and doc_id is not null")
    if sample_rows is None:
        return rows.select("text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = max(sample_rows // max(len(counts), 1), LEAST_ROWS)
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000))
    chosen = F.lit(True)
    for lang, n in counts.items():
        if n > share:
            chosen = chosen & ((F.col("lang") != lang) | (place < F.lit(int(1_000_000 * share / n) + 1)))
    return rows.filter(chosen).select("text", "lang")


def learn_prototypes(
    df: DataFrame, sample_rows: int | None = None, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> Prototypes:
    """Bundle the labelled documents of ``df``, all of them, into one prototype per language.

    With ``sample_rows`` about so many are used, the same number of each language, chosen by a hash of the id; of a
    language that has fewer, all, so every language keeps a prototype at any size. Null languages and
    texts are left out. Every document weighs the same whatever its length. Tasks add up their own
    documents, so what is gathered is one vector per language.
    """
    rows = _labelled(df, sample_rows, id_column, text_column, lang_column)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, vectors in document_vectors(batch.column(0)):
                scaled = np.round(_unit(vectors) * _SCALE).astype(np.int64)
                for i, vector in enumerate(scaled):
                    lang = langs[first + i]
                    sums[lang] = sums[lang] + vector if lang in sums else vector
        arrays = [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "vector"])

    parts = map_in_arrow(rows, bundle, "lang string, vector array<bigint>")
    summed = parts.select("lang", F.posexplode("vector").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"])
    table = stage(summed.groupBy("lang").agg(ordered.alias("vector")), "prototypes").df
    # One vector per language.
    learned = sorted((r["lang"], r["vector"]) for r in table.collect())
    vectors = np.array([v for _, v in learned], dtype=np.float64).reshape(-1, DIMENSIONS)
    return Prototypes([name for name, _ in learned], _unit(vectors))


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(df: DataFrame, prototypes: Prototypes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row: the nearest prototype by cosine.

    Whole texts count, however long. Null, empty and letterless texts are ``und`` with score 0, and so
    is everything without a prototype. Ties go to the smaller language name. A null id stays null and
    is not held out; other columns are not read.
    """
    rows = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = prototypes.predict(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
            )

    found = map_in_arrow(rows, predict, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def least_scores(
    df: DataFrame, prototypes: Prototypes, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> dict[int, float]:
    """By size of a text (see ``sizes``), the score that a text in a learned language reaches, measured on all labelled ones.

    The bar for a size is a share of the score that all but one in a thousand of the labelled texts of
    that size reach. Sizes with few labelled texts are left out; the next smaller one that is known
    counts for them, as scores rise with the number of different trigrams.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, found = prototypes.profile(batch.column(0))
            known = pa.array([n != UNKNOWN for n in names], pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(scores)], names=["size", "score"]).filter(known)

    rows = _labelled(df, None, id_column, text_column, lang_column)
    measured = map_in_arrow(rows, measure, "size bigint, score double").groupBy("size", "score")
    # Scores have six places, so those of a size are counted by value: the bar is exact, whatever the number of texts.
    counted = stage(measured.agg(F.count(F.lit(1)).alias("n")), "language-scores").df
    below = F.sum("n").over(Window.partitionBy("size").orderBy("score"))
    total = F.sum("n").over(Window.partitionBy("size"))
    reached = counted.withColumns({"below": below, "total": total}).filter(F.col("below") >= F.ceil(F.col("total") * _BAR_QUANTILE))
    bars = reached.groupBy("size").agg(F.min("score").alias("score"), F.first("total").alias("n"))
    return {r["size"]: _BAR_SHARE * r["score"] for r in bars.collect() if r["n"] >= _BAR_ROWS}


def is_known(names: list[str], scores: np.ndarray, found: np.ndarray, least: dict[int, float]) -> np.ndarray:
    """Whether texts are in a learned language: not ``und``, and up to the bar for their size."""
    bars = np.full(64, MIN_SCORE)
    for size in range(64):
        known = [s for s in least if s <= size]
        if known:
            bars[size] = max(least[max(known)], MIN_SCORE)
    return np.array([n != UNKNOWN for n in names], dtype=bool) & (scores >= bars[found])


def in_known_language(df: DataFrame, prototypes: Prototypes, least: dict[int, float] | None = None, text_column: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text is in a learned language: not ``und``, and near enough for its size."""
    place = df.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_known(*prototypes.profile(batch.column(place)), least or {}), pa.bool_()))

    return map_in_arrow(df, keep, df.schema)
