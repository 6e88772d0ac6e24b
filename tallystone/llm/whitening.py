"""Whitening of embeddings: principal components by a pivoted Cholesky factor and one-sided Jacobi rotations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallystone.llm.workers import map_in_arrow
from tallystone.sources.tables import stage

# Entries become whole numbers: floor(SCALE * entry) + SHIFT.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
# Vectors worked on at once by a task.
BLOCK_ROWS = 4096

# Sweeps over all pairs of columns; a handful is enough in practice.
_MOST_SWEEPS = 60
_MOST = 2**62
_EPSILON = float(np.finfo(np.float64).eps)


# ---- the decomposition, of one small matrix ---------------------------------------------


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``L, order`` with ``scatter[order][:, order] = L @ L.T``; L is lower triangular, a column per rank.

    The largest remaining diagonal entry comes next, ties by the smaller number. What remains below
    rounding (the size of the matrix times epsilon, of the largest entry) ends it.
    """
    d = len(scatter)
    rest, order = np.array(scatter, dtype=np.float64), np.arange(d)
    factor = np.zeros((d, d))
    least = d * _EPSILON * max(float(rest.diagonal().max(initial=0.0)), 0.0)
    for k in range(d):
        at = k + int(np.argmax(rest.diagonal()[k:]))
        if not rest[at, at] > least:
            return factor[:, :k], order
        for matrix in (rest, factor):
            matrix[[k, at]] = matrix[[at, k]]
        rest[:, [k, at]] = rest[:, [at, k]]
        order[[k, at]] = order[[at, k]]
        factor[k:, k] = rest[k:, k] / np.sqrt(rest[k, k])
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(columns: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of disjoint pairs, as in a tournament."""
    players = list(range(columns + columns % 2))
    found = []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(a, b) for a, b in zip(players[:half], players[half:][::-1], strict=True) if max(a, b) < columns]
        found.append(tuple(np.array(side, dtype=np.int64) for side in zip(*pairs, strict=True)))
        players.insert(1, players.pop())
    return found


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor times rotations after which its columns are orthogonal, longest first."""
    a = np.array(factor, dtype=np.float64)
    rounds = _rounds(a.shape[1]) if a.shape[1] > 1 else []
    for _ in range(_MOST_SWEEPS):
        turned = False
        for left, right in rounds:
            x, y = a[:, left], a[:, right]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(xy) > 4 * _EPSILON * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            with np.errstate(over="ignore"):
                zeta = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
                tangent = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cosine = 1.0 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            a[:, left], a[:, right] = cosine * x - sine * y, sine * x + cosine * y
        if not turned:
            break
    return a[:, np.argsort(-np.square(a).sum(axis=0), kind="stable")]


def principal_components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding, falling, and unit eigenvectors as columns, the largest entry positive."""
    factor, order = pivoted_cholesky(covariance)
    rotated = one_sided_jacobi(factor)
    lengths = np.sqrt(np.square(rotated).sum(axis=0))
    held = lengths > 0
    vectors = np.zeros((len(covariance), int(held.sum())))
    vectors[order] = rotated[:, held] / lengths[held]
    top = np.abs(vectors).argmax(axis=0) if vectors.size else np.empty(0, np.int64)
    return np.square(lengths[held]), vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


# ---- passes over the vectors ------------------------------------------------------------


def _whole_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors of whole numbers) for each length of vector among at most ``BLOCK_ROWS`` rows.

    Left out are vectors that are null or empty or hold a null or an entry that is not finite.
    """
    for at in range(0, len(column), BLOCK_ROWS):
        block = column.slice(at, BLOCK_ROWS)
        sizes = pc.fill_null(pc.list_value_length(block), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = block.flatten().to_numpy(zero_copy_only=False)  # nulls become NaN
        holders = np.repeat(np.arange(len(block)), sizes)
        odd = np.bincount(holders[~np.isfinite(values)], minlength=len(block)) > 0
        starts = np.cumsum(sizes) - sizes
        for size in np.unique(sizes[~odd & (sizes > 0)]).tolist():
            rows = np.flatnonzero(~odd & (sizes == size))
            with np.errstate(over="ignore"):
                scaled = np.floor(values[starts[rows][:, None] + np.arange(size)] * SCALE)
            # What is larger is refused later on.
            yield at + rows, np.clip(scaled, -float(_MOST), float(_MOST)).astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Fit:
    """What one pass over the vectors tells: their number, sums and greatest spread; exact integers."""

    rows: int
    sums: tuple[int, ...]
    spread: int

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """rows * x - sums, exact."""
        return x * np.int64(self.rows) - np.array(self.sums, dtype=np.int64)

    def deviations(self, centred: np.ndarray) -> pa.Array:
        """Sums of squares, exact: in machine integers where they must fit, else in Python's."""
        if self.dimensions * (self.rows * self.spread) ** 2 < 2**63:
            totals = np.square(centred).sum(axis=1).tolist()
        else:
            totals = [sum(v * v for v in row) for row in centred.tolist()]
        return pa.array([str(v) for v in totals], pa.string())


def _fit(vectors: DataFrame) -> Fit:
    """One row per dimension is gathered, whatever the number of vectors; of several lengths the most frequent counts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for _, x in _whole_vectors(batch.column(1)):
                # Upper and lower halves, so that no sum of a task overflows.
                new = [len(x), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), x.min(axis=0), x.max(axis=0)]
                old = parts.get(x.shape[1])
                parts[x.shape[1]] = new if old is None else [*map(np.add, old[:3], new[:3]), np.minimum(old[3], new[3]), np.maximum(old[4], new[4])]
        arrays = [pa.array([p[0] for p in parts.values()], pa.int64())]
        arrays += [pa.array([p[i] for p in parts.values()], pa.list_(pa.int64())) for i in range(1, 5)]
        yield pa.RecordBatch.from_arrays(arrays, names=["n", "high", "low", "least", "most"])

    lists = [f"{name} array<bigint>" for name in ("high", "low", "least", "most")]
    parts = map_in_arrow(vectors, add, ", ".join(["n bigint", *lists]))
    entry = F.posexplode(F.arrays_zip("high", "low", "least", "most")).alias("at", "e")
    entries = parts.select(F.size("high").alias("size"), "n", entry)
    total = lambda name: F.sum(F.col(f"e.{name}").cast("decimal(38,0)")).alias(name)
    counted = entries.groupBy("size", "at").agg(
        F.sum("n").alias("n"), total("high"), total("low"), F.min("e.least").alias("least"), F.max("e.most").alias("most")
    )
    counted = stage(counted, "entries").df
    common = counted.filter("at = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return Fit(0, (), 0)
    found = sorted(counted.filter(F.col("size") == common["size"]).collect(), key=lambda r: r["at"])
    n, spread = common["n"], max(r["most"] - r["least"] for r in found)
    largest = max(max(abs(r["least"]), abs(r["most"])) for r in found)
    if n * largest >= _MOST:
        raise ValueError(f"entries of up to {largest} in {n} vectors cannot be centred exactly in 64 bits")
    return Fit(n, tuple((int(r["high"]) << 32) + int(r["low"]) for r in found), spread)


def _gathered(df: DataFrame, width: int) -> np.ndarray:
    """Sums over all rows of the ``width`` numbers that every task has added up itself."""
    added = df.select(F.posexplode("part").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(width)
    for row in added.collect():
        out[row["at"]] = row["value"]
    return out


def _scatter(vectors: DataFrame, fit: Fit, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred vectors, or of what ``project`` makes of them; blocks are added up in each task."""
    d = fit.dimensions if project is None else project.shape[1]
    n = fit.rows

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d))
        seen = False
        for batch in batches:
            for _, x in _whole_vectors(batch.column(1)):
                if x.shape[1] == fit.dimensions:
                    y = fit.centred(x) / n
                    y = y if project is None else y @ project
                    total[:d] += y.T @ y
                    total[d] += y.sum(axis=0)
                    seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1)], pa.list_(pa.float64()))], names=["part"])

    parts = map_in_arrow(vectors, add, "part array<double>")
    total = _gathered(parts, (d + 1) * d).reshape(d + 1, d)
    mean = total[d] / n  # nothing but rounding
    return total[:d] / n - np.outer(mean, mean)


def whiten(
    df: DataFrame, id_column: str = "vec_id", embedding_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error`` for every usable row.

    Entries become whole numbers first (``SCALE``, ``SHIFT``). Counts and sums are exact, and vectors are
    centred exactly before anything is multiplied. The covariance, of the size of one vector squared, is
    taken apart on the driver; tasks project their own rows. ``whitened`` holds up to ``components``
    values of variance 1, that of the largest eigenvalue first, and ``explained`` the eigenvalues' shares of
    the trace. ``deviation`` is the exact sum of (n * x - S) ** 2, a decimal. ``identity_error`` is measured
    on the whitened vectors: the largest entry of their covariance minus the identity.

    Vectors that are null or hold a null or an entry that is not finite take no part, and neither do
    vectors of another length than the most frequent one (the longer, if two are as frequent) and empty
    ones. A null id stays null; repeated rows count each and give equal rows. Directions without variance
    have no component: equal vectors only give rows with empty lists. An empty table gives an empty result.
    Entries too large for exact integers are refused by an error before the work starts.
    """
    vectors = df.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(embedding_column).cast("array<double>").alias("v"))
    fit = _fit(vectors)
    covariance = _scatter(vectors, fit) if fit.rows else np.zeros((0, 0))
    values, directions = principal_components(covariance)
    values, directions = values[:components], directions[:, :components]
    project = directions / np.sqrt(values)
    explained = (values / covariance.trace()).tolist() if len(values) else []
    error = float(np.abs(_scatter(vectors, fit, project) - np.eye(len(values))).max()) if len(values) else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _whole_vectors(batch.column(1)):
                if x.shape[1] == fit.dimensions:
                    y = fit.centred(x)
                    white = (y / fit.rows) @ project
                    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * white.shape[1])
                    lists = pa.ListArray.from_arrays(ends, pa.array(white.reshape(-1)))
                    ids = batch.column(0).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([ids, fit.deviations(y), lists], names=["vec_id", "deviation", "whitened"])

    found = map_in_arrow(vectors, run, "vec_id bigint, deviation string, whitened array<double>")
    return found.select(
        "vec_id",
        F.lit(fit.rows).cast("bigint").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component."""
    opened = whitened.select(
        "vec_id", "n", F.col("deviation").cast("bigint").alias("deviation"), "explained", "identity_error",
        F.posexplode("whitened").alias("at", "whitened"),
    )
    return opened.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error",
    )
