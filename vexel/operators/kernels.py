"""NumPy helpers that run inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Elements of a temporary block; bounds the memory of one step.
_BLOCK = 1 << 22


def to_matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column as a (rows, dim) float32 matrix, without copying."""
    if vectors.null_count or (np.diff(vectors.offsets.to_numpy()) != dim).any():
        raise ValueError(f"embedding vector must be of length {dim}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float32, copy=False).reshape(len(vectors), dim)


def from_matrix(x: np.ndarray) -> pa.Array:
    """A (rows, dim) matrix as an Arrow list column."""
    rows, dim = x.shape
    ends = np.arange(0, rows * dim + 1, dim, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))


def ordered_dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise dot product, added up in double and in index order.

    Equal rows give equal doubles wherever they stand in a batch, which a BLAS
    product does not promise; ties then break by position alone.
    """
    total = np.zeros(len(x))
    step = max(1, _BLOCK // max(1, x.shape[1]))
    for lo in range(0, len(x), step):
        left = np.ascontiguousarray(x[lo : lo + step].T, dtype=np.float64)
        right = np.ascontiguousarray(y[lo : lo + step].T, dtype=np.float64)
        for a, b in zip(left, right):
            total[lo : lo + step] += a * b
    return total


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Each row scaled to unit length; zero rows stay."""
    norms = np.sqrt(ordered_dot(x, x))
    norms[norms == 0] = 1.0
    return (x.astype(np.float64) / norms[:, None]).astype(np.float32)


def drop_excess_copies(x: np.ndarray, pos: np.ndarray, k: int) -> np.ndarray:
    """Row numbers left when each distinct vector keeps its k lowest positions.

    A row with k equal vectors at lower positions is in no top k, whatever the
    query, so this loses nothing.
    """
    raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.strides[0]))).ravel()
    _, group = np.unique(raw, return_inverse=True)
    order = np.lexsort((pos, group))
    return order[_place_in_group(group[order]) < k]


def _place_in_group(group: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal values."""
    if not len(group):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    return np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))


def _true_cells(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.nonzero of a matrix, by way of its much faster flat form."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


class TopK:
    """The k best (score, position) pairs of each query seen so far.

    A float32 matrix product rules out most pairs; those within its rounding
    error of the k-th best are scored again by :func:`ordered_dot`, so the result
    is exact.  Memory is bounded by queries x k, whatever the number of rows.
    ``floor`` is a score per query that k other rows are known to reach: what is below
    it is in no top k and is let go at once.
    """

    def __init__(
        self, queries: np.ndarray, k: int, floor: np.ndarray | None = None
    ) -> None:
        self.queries = queries
        self.k = k
        self.floor = np.full(len(queries), -np.inf) if floor is None else floor
        self.norms = np.sqrt(np.einsum("ij,ij->i", queries, queries, dtype=np.float64))
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.pos = np.zeros(0, np.int64)

    def update(self, x: np.ndarray, pos: np.ndarray) -> None:
        if not len(x) or self.k == 0:
            return
        bound, full = self._current_bounds()
        width = max(1, _BLOCK // len(x))
        found = []
        for lo in range(0, len(self.queries), width):
            part = slice(lo, min(lo + width, len(self.queries)))
            rows, cols = self._candidates(x, pos, part, bound[part], full[part])
            if len(rows):
                found.append((cols + lo, self._exact(x, rows, cols + lo), pos[rows]))
        if found:
            self._merge(*(np.concatenate(column) for column in zip(*found)))

    def _exact(self, x: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        score = np.empty(len(rows))
        step = max(1, _BLOCK // max(1, x.shape[1]))
        for lo in range(0, len(rows), step):
            part = slice(lo, lo + step)
            score[part] = ordered_dot(x[rows[part]], self.queries[cols[part]])
        return score

    def _current_bounds(self) -> tuple[np.ndarray, np.ndarray]:
        count = np.bincount(self.query, minlength=len(self.queries))
        full = count == self.k
        bound = self.floor.copy()
        last = np.cumsum(count) - 1
        bound[full] = np.maximum(bound[full], self.score[last[full]])
        return bound, full

    def _candidates(self, x, pos, part, bound, full):
        with np.errstate(all="ignore"):
            norms = np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64))
            finite = norms[np.isfinite(norms)]
            longest = finite.max() if len(finite) else 0.0
            slack = (
                (x.shape[1] + 4)
                * float(np.finfo(np.float32).eps)
                * longest
                * self.norms[part]
            )
            rough = x @ self.queries[part].T
            low = bound - slack
            if len(x) > self.k and not full.all():
                # Until a query has k hits, the batch's own k-th best bounds it.
                known = np.where(np.isnan(rough), -np.inf, rough)
                kth = np.partition(known, len(x) - self.k, axis=0)[len(x) - self.k]
                low = np.fmax(low, kth - 2 * slack)
            low = np.nextafter(low.astype(np.float32), np.float32(-np.inf))
            # Written so that NaN and overflowed products stay in and are judged
            # by their exact score.
            keep = ~(rough < low)
            null = np.flatnonzero(self.norms[part] == 0)
            if len(null):
                # A zero query scores 0 against every finite row: all tie, and the
                # lowest positions win.
                keep[:, null] = False
                lowest = np.flatnonzero(np.isfinite(norms))
                lowest = lowest[np.argsort(pos[lowest], kind="stable")[: self.k]]
                keep[np.ix_(lowest, null)] = True
            if keep.sum() > 8 * self.k * keep.shape[1] + len(x):
                hot = np.flatnonzero(keep.any(axis=1))
                kept = hot[drop_excess_copies(x[hot], pos[hot], self.k)]
                rows, cols = _true_cells(keep[kept])
                return kept[rows], cols
        return _true_cells(keep)

    def kth(self) -> np.ndarray:
        """The k-th best score of each query, -inf where there are fewer hits."""
        if not self.k:
            return self.floor
        bound, full = self._current_bounds()
        return np.where(full, bound, self.floor)

    def _merge(self, query: np.ndarray, score: np.ndarray, pos: np.ndarray) -> None:
        # A score equal to the floor may still win by its position.
        real = score >= self.floor[query]
        query = np.concatenate([self.query, query[real]])
        score = np.concatenate([self.score, score[real]])
        pos = np.concatenate([self.pos, pos[real]])
        order = np.lexsort((pos, -score, query))
        best = order[_place_in_group(query[order]) < self.k]
        self.query, self.score, self.pos = query[best], score[best], pos[best]
