"""Nearest neighbours by collision counting over single projections.

Every shard of vectors keeps, for each of a number of random directions, its vectors sorted by their
projection. A query's window is centred at its own projection and widened step by step (virtual
rehashing); a vector that lies in the windows of enough directions is verified with its exact distance.
A radius R belongs to each width: vectors within R collide in a direction with probability ``REACH`` or
more, and the threshold on collisions is ``margin`` standard deviations below what they reach on average. The
search in a shard ends when the k-th distance found is at most R, so what it misses are vectors unlucky
by that margin; when the windows have been widened ``steps`` times, all the rest is verified. The index
holds every vector. Distances are computed in double precision on the original vectors.

Vectors that are null, empty, zero or hold null or non-finite components, and null ids, take no part;
vectors of different lengths do not meet. An id is one item: of repeated rows with different vectors the
nearest counts, and a query skips all rows with its own id. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackline.llm.vectors import best, matrix, merged, tiles, usable

REACH = math.erf(1 / math.sqrt(2))  # a window's half width is R: one standard deviation at distance R


class CollisionIndex:
    """Sorted projections of one shard."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, directions: int, seed: int):
        self.ids, self.rows = ids, rows
        self.lines = np.random.default_rng(seed).normal(size=(directions, rows.shape[1]))
        projected = rows @ self.lines.T
        self.order = np.argsort(projected, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(projected, self.order.T.astype(np.int64), axis=0).T.copy()

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, margin: float, steps: int, growth: float):
        """For each query the ids and distances of its nearest vectors found."""
        directions, n = self.sorted.shape
        at = queries @ self.lines.T
        first = self._first_width(at)
        widths = first[:, None] * growth ** np.arange(steps)
        left = np.empty((len(queries), steps, directions), np.int32)
        right = np.empty_like(left)
        for d in range(directions):
            left[:, :, d] = np.searchsorted(self.sorted[d], at[:, d, None] - widths, "left")
            right[:, :, d] = np.searchsorted(self.sorted[d], at[:, d, None] + widths, "right")
        enough = math.floor(directions * REACH - margin * math.sqrt(directions * REACH * (1 - REACH)))
        for q, query in enumerate(queries):
            yield self._one(own[q], query, widths[q], left[q], right[q], max(enough, 1), k)

    def _first_width(self, at: np.ndarray, share: float = 0.2) -> np.ndarray:
        """Per query the middle, over directions, of the width that holds a share of the vectors."""
        directions, n = self.sorted.shape
        half = max(1, int(share * n) // 2)
        out = np.empty_like(at)
        for d in range(directions):
            line = self.sorted[d]
            place = np.searchsorted(line, at[:, d])
            low, high = np.maximum(place - half, 0), np.minimum(place + half, n - 1)
            out[:, d] = np.maximum(np.abs(at[:, d] - line[low]), np.abs(line[high] - at[:, d]))
        width = np.median(out, axis=1)
        return np.where(width > 0, width, np.maximum(out.max(axis=1), 1e-300))

    def _one(self, own, query, widths, left, right, enough: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        hits = np.zeros(n, np.int64)
        fresh = self.ids != own
        ids, distances = np.empty(0, self.ids.dtype), np.empty(0)
        before_left = before_right = None
        for step, width in enumerate(widths):
            if step == 0:
                new = [self.order[d, a:b] for d, (a, b) in enumerate(zip(left[0].tolist(), right[0].tolist()))]
            else:
                new = [self.order[d, a:b] for d, (a, b) in enumerate(zip(left[step].tolist(), before_left))]
                new += [self.order[d, a:b] for d, (a, b) in enumerate(zip(before_right, right[step].tolist()))]
            before_left, before_right = left[step].tolist(), right[step].tolist()
            hits += np.bincount(np.concatenate(new), minlength=n)
            checked = np.flatnonzero((hits >= enough) & fresh)
            fresh[checked] = False
            ids, distances = self._verified(query, checked, ids, distances, k)
            if len(ids) >= k and distances[k - 1] <= width:
                return ids, distances
        return self._verified(query, np.flatnonzero(fresh), ids, distances, k)

    def _verified(self, query, checked, ids, distances, k):
        if not len(checked):
            return ids, distances
        exact = np.sqrt(((self.rows[checked] - query) ** 2).sum(axis=1))
        return best(np.concatenate([ids, self.ids[checked]]), np.concatenate([distances, exact]), k)


def search(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    directions: int = 128,
    margin: float = 2.0,
    steps: int = 24,
    growth: float = 1.2,
    seed: int = 5,
    shard_rows: int = 8192,
    block_rows: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id, score (distance) of each query's k nearest found. ``is_query`` is a condition on "id"."""
    rows = usable(table, key, vector, zero=False)
    grid, shards = tiles(rows, is_query, shard_rows, block_rows)
    kind = table.schema[key].dataType.simpleString()

    def tile(group: tuple, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        asked, own, near, cost = [], [], [], []
        if candidates.num_rows and queries.num_rows:
            index = CollisionIndex(*matrix(candidates), directions, seed)
            ids, vectors = matrix(queries)
            for begin in range(0, len(ids), 128):
                some = slice(begin, begin + 128)
                for query, (found, far) in zip(
                    ids[some], index.search(ids[some], vectors[some], k, margin, steps, growth)
                ):
                    asked.append(np.full(len(found), query))
                    near.append(found)
                    cost.append(far)
        join = lambda parts, like: np.concatenate(parts) if parts else np.empty(0, like)
        return pa.table(
            {
                "query_id": join(asked, np.int64),
                "part": np.full(sum(map(len, asked)), group[1].as_py(), np.int32),
                "vec_id": join(near, np.int64),
                "cost": join(cost, np.float64),
            }
        )

    found = grid.applyInArrow(tile, f"query_id {kind}, part int, vec_id {kind}, cost double")
    return merged(found, shards, k).withColumnRenamed("cost", "score")
