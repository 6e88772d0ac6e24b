"""Links between shingle sets of two blocks, by exact intersections; only a spanning forest of them is handed out."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# A shingle held by this share of the pairs of two blocks is counted by matrix products, a rarer one pair by pair.
_DENSE_SHARE = 1 / 64
# Columns of a product, and pairs expanded, at once.
_COLUMNS = 2048
_PAIRS = 1 << 20


@dataclass(frozen=True)
class Sets:
    """Rows with a node, its component so far, the size of its set, and the set: ``values[bounds[i]:bounds[i + 1]]``."""

    nodes: np.ndarray
    components: np.ndarray
    sizes: np.ndarray
    values: np.ndarray
    bounds: np.ndarray

    def rows_of_values(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.nodes)), np.diff(self.bounds))

    def take(self, rows: np.ndarray, held: np.ndarray) -> Sets:
        """Some rows, and of their sets the values marked in ``held``; sizes stay those of the whole sets."""
        chosen = np.zeros(len(self.nodes), bool)
        chosen[rows] = True
        held = held & np.repeat(chosen, np.diff(self.bounds))
        counts = np.bincount(self.rows_of_values()[held], minlength=len(self.nodes))[rows]
        return Sets(self.nodes[rows], self.components[rows], self.sizes[rows], self.values[held], np.concatenate([[0], np.cumsum(counts)]))


def _in_other_components(own: Sets, other: Sets) -> np.ndarray:
    """For every value of ``own``: whether a set of ``other`` in another component holds it."""
    if not len(own.values) or not len(other.values):
        return np.zeros(len(own.values), bool)
    order = np.argsort(other.values, kind="stable")
    values, held_by = other.values[order], other.components[other.rows_of_values()][order]
    heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    distinct = values[heads]
    least, most = np.minimum.reduceat(held_by, heads), np.maximum.reduceat(held_by, heads)
    at = np.minimum(np.searchsorted(distinct, own.values), len(distinct) - 1)
    component = own.components[own.rows_of_values()]
    return (distinct[at] == own.values) & ((least[at] != component) | (most[at] != component))


def prune(left: Sets, right: Sets, percent: int, rounds: int = 3) -> tuple[Sets, Sets]:
    """Leave out rows that cannot be linked, in time linear in the sets.

    A link's intersection is at least ``percent`` of the union, so of either set. A row of whose shingles
    fewer than that occur on the other side, in another component, has no link. Neither side keeps
    shingles that the other one lacks.
    """
    for _ in range(rounds):
        before = len(left.nodes) + len(right.nodes)
        sides = []
        for own, other in ((left, right), (right, left)):
            held = _in_other_components(own, other)
            common = np.bincount(own.rows_of_values()[held], minlength=len(own.nodes))
            sides.append(own.take(np.flatnonzero((common > 0) & (100 * common >= percent * own.sizes)), held))
        left, right = sides
        if len(left.nodes) + len(right.nodes) == before or not len(left.nodes) or not len(right.nodes):
            break
    return left, right


def intersections(left: Sets, right: Sets) -> np.ndarray:
    """How many values every left set has in common with every right set."""
    out = np.zeros((len(left.nodes), len(right.nodes)), np.float32)
    common = np.intersect1d(left.values, right.values)
    if not len(common):
        return out
    sides = []
    for own in (left, right):
        at = np.minimum(np.searchsorted(common, own.values), len(common) - 1)
        held = common[at] == own.values
        columns, rows = at[held], own.rows_of_values()[held]
        order = np.argsort(columns, kind="stable")
        columns, rows = columns[order], rows[order]
        sides.append((columns, rows, np.searchsorted(columns, np.arange(len(common) + 1))))
    (a_columns, a_rows, a_ends), (b_columns, b_rows, b_ends) = sides
    a_counts, b_counts = np.diff(a_ends), np.diff(b_ends)
    dense = a_counts * b_counts >= _DENSE_SHARE * out.size
    for chunk in np.array_split(np.flatnonzero(dense), int(dense.sum()) // _COLUMNS + 1):
        place = np.full(len(common), -1)
        place[chunk] = np.arange(len(chunk))
        matrices = []
        for n, columns, rows in ((len(left.nodes), a_columns, a_rows), (len(right.nodes), b_columns, b_rows)):
            at = place[columns]
            matrix = np.zeros((n, len(chunk)), np.float32)
            matrix[rows[at >= 0], at[at >= 0]] = 1
            matrices.append(matrix)
        out += matrices[0] @ matrices[1].T
    rare = np.flatnonzero(~dense)
    totals = np.cumsum(a_counts[rare] * b_counts[rare])
    flat = out.reshape(-1)
    for chunk in np.split(rare, np.searchsorted(totals, np.arange(_PAIRS, totals[-1], _PAIRS)) if len(rare) else []):
        # Every left row of a column with every right row of it.
        a, b = a_counts[chunk], b_counts[chunk]
        ends = np.cumsum(a * b)
        column = np.repeat(np.arange(len(chunk)), a * b)
        within = np.arange(ends[-1] if len(ends) else 0) - (ends - a * b)[column]
        x = a_rows[a_ends[chunk][column] + within // b[column]]
        y = b_rows[b_ends[chunk][column] + within % b[column]]
        pairs, times = np.unique(x * len(right.nodes) + y, return_counts=True)
        flat[pairs] += times
    return out


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a matrix of links between left and right rows, links that connect what all of them connect; fewer than rows."""
    unseen_left, unseen_right = np.ones(linked.shape[0], bool), np.ones(linked.shape[1], bool)
    found: list[tuple[int, int]] = []
    for start in range(linked.shape[0]):
        if not unseen_left[start]:
            continue
        unseen_left[start] = False
        open_rows = [(start, True)]
        while open_rows:
            row, is_left = open_rows.pop()
            if is_left:
                reached = np.flatnonzero(linked[row] & unseen_right)
                unseen_right[reached] = False
            else:
                reached = np.flatnonzero(linked[:, row] & unseen_left)
                unseen_left[reached] = False
            for x in reached.tolist():
                found.append((row, x) if is_left else (x, row))
                open_rows.append((x, not is_left))
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def links(left: Sets, right: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of links between sets of different components, ``100 * intersection >= percent * union``; a spanning forest."""
    left, right = prune(left, right, percent)
    if not len(left.nodes) or not len(right.nodes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    common = intersections(left, right).astype(np.int64)
    union = left.sizes[:, None] + right.sizes[None, :] - common
    linked = (common > 0) & (100 * common >= percent * union) & (left.components[:, None] != right.components[None, :])
    a, b = forest(linked)
    return left.nodes[a], right.nodes[b]
