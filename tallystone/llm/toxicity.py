"""Toxicity by a classifier chain: each category's linear model also sees the earlier categories' probabilities."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallystone.llm.arrow_text import chunks
from tallystone.llm.words import hash_spans, lower_ascii, mix, word_spans
from tallystone.llm.workers import map_in_arrow, per_group
from tallystone.sources.tables import stage

# Hashed features of a text: its distinct words, and their first bytes, for compounds and inflections.
FEATURE_BITS = 18
STEM_BYTES = (4, 5)
# Labelled rows the chain learns from, at most.
SAMPLE_ROWS = 10_000
FOLDS = 3
EPOCHS = 20
THRESHOLD = 0.4

# A feature counts if it is in so many rows of the training data, and its share of positive ones is so
# many standard deviations from the mean: rare words would only tell the training rows apart.
LEAST_ROWS = 4
LEAST_DEVIATIONS = 3.0

_BATCH = 64
_BLOCK_ROWS = 512
_RATE = 0.2
_SHRINK = 1e-5
# Earlier probabilities enter as log odds within these limits.
_MOST_ODDS = 6.0
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, feature numbers, bounds): the distinct features of groups of whole rows."""
    parts: list[np.ndarray] = []
    for chunk in chunks(column):
        data = lower_ascii(chunk.data)
        starts, ends, firsts = word_spans(data, chunk.bounds)
        for _ in range(3):  # marks around a word are not part of it
            ends = np.where(_IS_MARK[data[ends - 1]] & (ends - starts > 1), ends - 1, ends)
            starts = np.where(_IS_MARK[data[starts]] & (ends - starts > 1), starts + 1, starts)
        kinds = [hash_spans(data, starts, ends)]
        kinds += [mix(hash_spans(data, starts, np.minimum(starts + n, ends)) + np.uint64(n)) for n in STEM_BYTES]
        rows = np.tile(np.repeat(np.arange(len(firsts) - 1), np.diff(firsts)), len(kinds))
        found = np.concatenate(kinds) >> np.uint64(64 - FEATURE_BITS)
        keyed = np.unique((rows << FEATURE_BITS) | found.astype(np.int64))
        numbers = keyed & ((1 << FEATURE_BITS) - 1)
        bounds = np.searchsorted(keyed, np.arange(len(firsts)) << FEATURE_BITS)
        if parts or not chunk.last:
            parts.append(numbers)
            if chunk.last:
                numbers = np.unique(np.concatenate(parts))
                parts = []
                yield chunk.first, numbers, np.array([0, len(numbers)])
        else:
            yield chunk.first, numbers, bounds


@dataclass(frozen=True)
class LinearModel:
    """Weights of the hashed features and of the earlier categories' log odds, and the base log odds."""

    weights: np.ndarray
    earlier: np.ndarray
    base: float

    def odds(self, numbers: np.ndarray, bounds: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[numbers], dtype=np.float64)])
        return sums[bounds[1:]] - sums[bounds[:-1]] + earlier @ self.earlier + self.base


def probability(odds: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.clip(np.log(p / (1 - p)), -_MOST_ODDS, _MOST_ODDS)


def fit(numbers: np.ndarray, bounds: np.ndarray, earlier: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> LinearModel:
    """Logistic regression on the telling features, by Adagrad over small batches in the given order of rows.

    Without rows, or with one class only, a constant: the smoothed share of positive labels.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    base = float(np.log(share / (1 - share)))
    model = LinearModel(np.zeros(1 << FEATURE_BITS, np.float32), np.zeros(earlier.shape[1]), base)
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    held = _telling(numbers, bounds, labels)[numbers]
    kept = np.add.reduceat(np.append(held, False), bounds[:-1], dtype=np.int64) * (bounds[1:] > bounds[:-1])
    numbers, bounds = numbers[held], np.concatenate([[0], np.cumsum(kept)])
    weights, more = model.weights, model.earlier
    seen, seen_more, seen_base = np.full(len(weights), 1e-2, np.float32), np.full(len(more), 1e-2), 1e-2
    for _ in range(epochs):
        for at in range(0, len(labels), _BATCH):
            end = min(at + _BATCH, len(labels))
            ids = numbers[bounds[at] : bounds[end]]
            local = bounds[at : end + 1] - bounds[at]
            z = earlier[at:end]
            error = probability(LinearModel(weights, more, base).odds(ids, local, z)) - labels[at:end]
            touched, which = np.unique(ids, return_inverse=True)
            slope = np.bincount(which, np.repeat(error, np.diff(local)), len(touched)).astype(np.float32)
            slope += _SHRINK * len(error) * weights[touched]
            seen[touched] += slope * slope
            weights[touched] -= _RATE * slope / np.sqrt(seen[touched])
            slope_more = z.T @ error
            seen_more += slope_more**2
            more -= _RATE * slope_more / np.sqrt(seen_more)
            seen_base += error.sum() ** 2
            base -= _RATE * error.sum() / np.sqrt(seen_base)
    return LinearModel(weights, more, float(base))


def _telling(numbers: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Which features are in enough rows, and in more or fewer positive ones than chance has it."""
    rows, positive = np.zeros(1 << FEATURE_BITS), np.zeros(1 << FEATURE_BITS)
    for at in range(0, len(labels), _BLOCK_ROWS):
        held = bounds[at : at + _BLOCK_ROWS + 1]
        ids, y = numbers[held[0] : held[-1]], labels[at : at + _BLOCK_ROWS]
        rows += np.bincount(ids, minlength=1 << FEATURE_BITS)
        positive += np.bincount(ids, np.repeat(y, np.diff(held)), 1 << FEATURE_BITS)
    share = labels.mean()
    spread = np.sqrt(np.maximum(rows * share * (1 - share), 1e-9))
    return (rows >= LEAST_ROWS) & (np.abs(positive - rows * share) >= LEAST_DEVIATIONS * spread)


def _sample(df: DataFrame, labels: DataFrame, categories: Sequence[str], rows: int, id_column: str, text_column: str) -> DataFrame:
    """``row, fold, labels, numbers`` of at most ``rows`` labelled documents, chosen by a hash of the id."""
    y = F.array(*[F.col(c).cast("double") for c in categories]).alias("labels")
    known = labels.select(F.col(id_column).cast("bigint").alias("_id"), y).filter("_id is not null")
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "labels").limit(rows)
    texts = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    # At most ``rows`` small rows, so the texts need not be shuffled to be found.
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "labels")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = [np.empty(0, np.int32)] * len(batch)
            for first, numbers, bounds in features(batch.column(1)):
                for i in range(len(bounds) - 1):
                    found[first + i] = numbers[bounds[i] : bounds[i + 1]].astype(np.int32)
            arrays = [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "labels", "numbers"])

    numbered = map_in_arrow(joined, number, "doc_id bigint, labels array<double>, numbers array<int>")
    return numbered.withColumns({"row": F.monotonically_increasing_id(), "fold": F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))})


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All lists end to end, and where each begins."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], column.type)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _fit_task(place: int) -> Callable[[pa.Table], pa.Table]:
    """Fits category ``place`` without one fold: that fold's probabilities; or on all folds: the model."""

    def fit_group(table: pa.Table) -> pa.Table:
        # In a fixed order of rows, without copying the lists.
        ranks = pc.sort_indices(table.select(["doc_id", "row"]), [("doc_id", "ascending"), ("row", "ascending")]).to_numpy()
        left_out = table.column("fit")[0].as_py()
        numbers, bounds = _flat(table.column("numbers"))
        categories = len(table.column("labels")[0])
        label = _flat(table.column("labels"))[0].reshape(-1, categories)[:, place].astype(float)
        earlier = log_odds(_flat(table.column("earlier"))[0].astype(float).reshape(len(label), place))
        fold = table.column("fold").to_numpy()
        ranked = np.empty(len(label), np.uint64)
        ranked[ranks] = mix(np.arange(1, len(label) + 1, dtype=np.uint64))
        used = np.flatnonzero(~np.isnan(label) & (fold != left_out))
        order = used[np.argsort(ranked[used])]
        ids = np.concatenate([numbers[bounds[i] : bounds[i + 1]] for i in order] or [np.empty(0, np.int32)])
        model = fit(ids, np.concatenate([[0], np.cumsum(np.diff(bounds)[order])]), earlier[order], label[order])
        if left_out < FOLDS:
            rows = np.flatnonzero(fold == left_out)
            p = [probability(model.odds(numbers[bounds[i] : bounds[i + 1]], np.array([0, bounds[i + 1] - bounds[i]]), earlier[i : i + 1]))[0] for i in rows]
            return pa.table(
                {"row": table.column("row").take(pa.array(rows)), "p": pa.array(p, pa.float64()), "model": pa.nulls(len(rows), pa.binary())}
            )
        packed = np.concatenate([[model.base], model.earlier, model.weights]).astype(np.float32).tobytes()
        return pa.table({"row": pa.array([-1], pa.int64()), "p": pa.array([0.0]), "model": pa.array([packed], pa.binary())})

    return fit_group


def train_chain(
    df: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> list[LinearModel]:
    """One model per category, in the chain's order.

    The sample is bounded by ``sample_rows``. Every category is fitted ``FOLDS + 1`` times, each fit a
    task of its own: once per fold left out, for the probabilities that the next categories learn from,
    and once on the whole sample, for the final model. So no model learns from a probability that its
    own row's label has shaped. Rows whose label is null are left out for that category.
    """
    data = stage(_sample(df, labels, categories, sample_rows, id_column, text_column), "toxicity-sample").df
    data = data.withColumn("earlier", F.array().cast("array<double>"))
    models: list[LinearModel] = []
    fits = F.explode(F.sequence(F.lit(0), F.lit(FOLDS)))
    for place in range(len(categories)):
        grouped = data.withColumn("fit", fits).groupBy("fit")
        fitted = stage(grouped.applyInArrow(per_group(df.sparkSession, _fit_task(place)), "row bigint, p double, model binary"), "toxicity-fit").df
        final = fitted.filter("row = -1").select("model").first()
        if final is None:  # not one labelled row
            models.append(LinearModel(np.zeros(1 << FEATURE_BITS, np.float32), np.zeros(place), 0.0))
            continue
        packed = np.frombuffer(final["model"], np.float32)
        models.append(LinearModel(packed[1 + place :], packed[1 : 1 + place].astype(float), float(packed[0])))
        out_of_fold = fitted.filter("row >= 0").select("row", "p")
        data = data.join(out_of_fold, "row").withColumn("earlier", F.concat("earlier", F.array("p"))).drop("p")
    return models


def _scores(models: list[LinearModel], column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities per row and category, category by category along the chain; whether a row has words."""
    out = np.zeros((len(column), len(models)))
    filled = np.zeros(len(column), bool)

    def chain(numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        p = np.zeros((len(bounds) - 1, len(models)))
        for j, model in enumerate(models):
            p[:, j] = probability(model.odds(numbers, bounds, log_odds(p[:, :j])))
        return p

    for first, numbers, bounds in features(column):
        at = slice(first, first + len(bounds) - 1)
        out[at] = chain(numbers, bounds)
        filled[at] = np.diff(bounds) > 0
    out[~filled] = chain(np.empty(0, np.int64), np.zeros(2, np.int64))
    return out, filled


def _positive(models: list[LinearModel], column: pa.Array, at: int, threshold: float) -> np.ndarray:
    p, filled = _scores(models, column)
    return filled & (p[:, at] >= threshold)


def predict_chain(
    df: DataFrame,
    models: list[LinearModel],
    categories: Sequence[str],
    verdict: str = "toxic",
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, p_<category>..., is_<verdict>`` for every row; whole texts, however long.

    Null, empty and blank texts get the base probabilities and are never positive. A null id stays
    null; repeated rows get equal scores; other columns are not read.
    """
    at = list(categories).index(verdict)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, filled = _scores(models, batch.column(1))
            hit = filled & (p[:, at] >= threshold)
            arrays = [batch.column(0), *[pa.array(p[:, j]) for j in range(len(categories))], pa.array(hit)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *[f"p_{c}" for c in categories], f"is_{verdict}"])

    rows = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = ", ".join(["doc_id bigint", *[f"p_{c} double" for c in categories], f"is_{verdict} boolean"])
    return map_in_arrow(rows, score, schema)


def without_toxic(
    df: DataFrame, models: list[LinearModel], categories: Sequence[str], verdict: str = "toxic", threshold: float = THRESHOLD, text_column: str = "text"
) -> DataFrame:
    """The rows of ``df``, all columns, whose text is not positive; null and blank texts stay."""
    at, place = list(categories).index(verdict), df.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~_positive(models, batch.column(place), at, threshold)))

    return map_in_arrow(df, keep, df.schema)
