"""Exact top-k inner products by pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystone.llm.workers import map_in_arrow, per_group
from tallystone.sources.tables import stage

K = 20
PIVOTS = 32
SCALE = 64
# Rows that one task holds of the queries and of the candidates.
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16_384

# Candidates scored before the first bound is compared, and between later comparisons.
_STEP = 512
# Integers below are exact in double precision.
_MOST_EXACT = 2**53


def integer_vectors(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of every component, for usable vectors; one vector per id.

    Vectors that are null, or hold a null or non-finite component, and null ids are left out. Of several
    vectors with one id the smallest, component by component, is taken.
    """
    x = F.col(vector_column)
    broken = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(scale)))  # at most the largest bigint
    usable = df.filter(x.isNotNull() & F.col(id_column).isNotNull()).filter(~broken)
    rows = usable.select(F.col(id_column).cast("bigint").alias("vec_id"), whole.alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows as float64, exact for the integers at hand; shorter vectors are padded with zeros."""
    out = np.zeros((len(column), width))
    for i, values in enumerate(column.to_pylist()):
        out[i, : len(values)] = values
    return out


def _fixed_matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [np.asarray(c.flatten().to_numpy(zero_copy_only=False), np.float64) for c in chunks]
    return (np.concatenate(flat) if flat else np.empty(0)).reshape(-1, width)


def _pivot_distances(vectors: np.ndarray, lifted: np.ndarray, pivots: np.ndarray, most: float) -> np.ndarray:
    """Distances to the pivots in the lifted space.

    A candidate x gets one more coordinate, sqrt(most - |x|**2), a query gets 0. Then all candidates have
    the same length, and the largest inner product is the smallest distance, a metric.
    """
    last = np.sqrt(np.maximum(most - (pivots**2).sum(axis=1), 0.0))
    squares = (vectors**2).sum(axis=1)[:, None] + lifted[:, None] ** 2 + most - 2 * (vectors @ pivots.T + lifted[:, None] * last)
    return np.sqrt(np.maximum(squares, 0.0))


def _kth(scores: np.ndarray, k: int) -> float:
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def _search(query: np.ndarray, own: int, reach: np.ndarray, vectors: np.ndarray, ids: np.ndarray, reaches: np.ndarray, most: float, k: int):
    """The k best (id, score) of a block, scoring candidates in the order of their bounds.

    ``reaches`` has a row per pivot. The triangle inequality gives each pivot's lower bound on the
    distance; the greatest of them is an upper bound on the score. Scoring stops where no bound reaches
    the k-th score; equal ones are scored, as a smaller id may win the tie. Where the bounds leave more
    than a quarter of the block, all of it is scored by one product: gathering those rows costs more.
    """
    nearest = np.zeros(len(ids))
    for distances, own_distance in zip(reaches, reach, strict=True):
        np.maximum(nearest, np.abs(distances - own_distance), out=nearest)
    square = float((query.astype(np.float64) ** 2).sum()) + most
    # Slack for rounding in the distances; a bound may be too high, never too low.
    bound = np.floor((square - nearest * nearest) / 2 + 1e-6 * square + 1.0)
    bound[ids == own] = -np.inf
    left = np.flatnonzero(bound > -np.inf)
    if len(left) > _STEP:
        head = np.argpartition(-bound, _STEP)[:_STEP]
        head = head[bound[head] > -np.inf]
    else:
        head = left
    found_ids, found = ids[head], vectors[head] @ query
    if len(left) > len(head):
        worst = _kth(found, k)
        rest = left[bound[left] >= worst]
        if len(rest) > len(ids) // 4:
            found_ids, found = ids[rest], (vectors @ query)[rest]
        else:
            rest = np.setdiff1d(rest, head, assume_unique=True)
            rest = rest[np.argsort(-bound[rest], kind="stable")]
            for at in range(0, len(rest), _STEP):
                part = rest[at : at + _STEP]
                if bound[part[0]] < worst:
                    break
                found_ids, found = np.concatenate([found_ids, ids[part]]), np.concatenate([found, vectors[part] @ query])
                worst = max(worst, _kth(found, k))
    good = np.flatnonzero(found >= _kth(found, k))
    best = good[np.lexsort((found_ids[good], -found[good]))[:k]]
    return found_ids[best], found[best]


def exact_top_k(
    df: DataFrame,
    is_query: Column,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
    pivots: int = PIVOTS,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest integer inner products, exactly.

    ``is_query`` is a condition on ``vec_id``; every other row is a candidate of each query. Distances
    of all rows to a few pivots are worked out once and written. Queries and candidates are dealt into
    blocks by a hash of the id; a task meets one block of each and hands out k rows per query, which are
    merged per query. Memory is bounded by the block sizes, and no row is compared by its components
    whose bound excludes it.

    Ties go to the smaller id; with fewer candidates than k all are returned. Unusable vectors and null
    ids take no part (see ``integer_vectors``); shorter vectors count as padded with zeros. Components so
    large that a sum of products could exceed 2**53 are refused by an error before the search starts, as
    the scores would not be exact. An empty table gives an empty result.
    """
    rows = stage(integer_vectors(df, id_column, vector_column, scale), "vectors").df
    extremes = rows.agg(F.max(F.size("v")).alias("width"), F.min(F.array_min("v")).alias("least"), F.max(F.array_max("v")).alias("most")).first()
    largest = max(abs(extremes["least"] or 0), abs(extremes["most"] or 0))
    if (extremes["width"] or 0) * largest**2 >= _MOST_EXACT:
        raise ValueError(f"components of up to {largest} times 1/{scale} in {extremes['width']} dimensions: inner products would not be exact")
    squares = F.aggregate("v", F.lit(0).cast("bigint"), lambda total, c: total + c * c)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.max(squares).alias("most")).first()
    n, width, most = size["n"], max(size["width"] or 1, 1), float(size["most"] or 0)
    queries = rows.filter(is_query)
    # PIVOTS rows, whatever the table's size.
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    pivot_rows = _matrix(pa.array([r["v"] for r in chosen], pa.list_(pa.int64())), width)

    def measure(lift: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = _matrix(batch.column(1), width)
                lifted = np.sqrt(np.maximum(most - (vectors**2).sum(axis=1), 0.0)) if lift else np.zeros(len(vectors))
                reach = _pivot_distances(vectors, lifted, pivot_rows, most)
                as_lists = [pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.ravel())) for m in (vectors, reach)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *as_lists], names=["vec_id", "v", "reach"])

        return run

    schema = "vec_id bigint, v array<double>, reach array<double>"
    query_blocks = max(1, ceil(queries.count() / query_block))
    candidate_blocks = max(1, ceil(n / candidate_block))
    pieces = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    block = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    measured = stage(map_in_arrow(rows, measure(True), schema), "pivot-table").df
    left = map_in_arrow(queries, measure(False), schema).withColumns({"qb": block(query_blocks), "cb": pieces(candidate_blocks)})
    right = measured.withColumns({"cb": block(candidate_blocks), "qb": pieces(query_blocks)})

    def meet(asking: pa.Table, asked: pa.Table) -> pa.Table:
        out_q, out_id, out_score = [], [], []
        if asking.num_rows and asked.num_rows:
            # Sums stay below ``most``, so single precision is exact up to 2**24.
            exact = np.float32 if most < 2**24 else np.float64
            vectors = _fixed_matrix(asked.column("v"), width).astype(exact)
            reaches = np.ascontiguousarray(_fixed_matrix(asked.column("reach"), len(pivot_rows)).T)
            ids = asked.column("vec_id").to_numpy()
            asking_v, asking_reach = _fixed_matrix(asking.column("v"), width).astype(exact), _fixed_matrix(asking.column("reach"), len(pivot_rows))
            for i, own in enumerate(asking.column("vec_id").to_pylist()):
                found, scores = _search(asking_v[i], own, asking_reach[i], vectors, ids, reaches, most, k)
                out_q += [own] * len(found)
                out_id += found.tolist()
                out_score += scores.astype(np.int64).tolist()
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_id, pa.int64()), "score": pa.array(out_score, pa.int64())})

    meet = per_group(df.sparkSession, meet)
    met = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(meet, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
