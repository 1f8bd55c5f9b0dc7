"""Exact top-k search by integer inner products: tiled matrix products, partial selection, merging of lists.

Each component x becomes floor(scale * x). A tile multiplies a block of queries with a shard of candidates, in
doubles where all sums stay below 2^53 and so are exact, else in unbounded integers (results
beyond the range of long are set to its ends). Of each tile a query keeps its k best; lists are merged
in a tree.

Vectors that are null, empty or hold null or non-finite components, and null ids, take no part;
vectors of different lengths do not meet. An id is one item: of repeated rows with different vectors the
best counts, and a query skips all rows with its own id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackline.llm.vectors import matrix, merged, tiles, usable

LONGEST = 2**63 - 1


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held in doubles, exactly, as longs."""
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * rows.shape[1]
    if most < 2**53:
        return (queries @ rows.T).astype(np.int64)
    exact = np.array([[int(x) for x in q] for q in queries], object) @ np.array(
        [[int(x) for x in r] for r in rows], object
    ).T
    return np.clip(exact, -LONGEST, LONGEST).astype(np.int64)


def top(ids: np.ndarray, scores: np.ndarray, own, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (which ascend) and scores of the k best, best first, ties to smaller ids, without ``own``."""
    others = ids != own
    ids, scores = ids[others], scores[others]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        some = np.concatenate([above, equal[: k - len(above)]])
        ids, scores = ids[some], scores[some]
    order = np.lexsort([ids, -scores])
    return ids[order], scores[order]


def search(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
    shard_rows: int = 4096,
    block_rows: int = 1024,
    rows_at_once: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best. ``is_query`` is a condition on "id"."""
    rows = usable(table, key, vector, zero=True)
    grid, shards = tiles(rows, is_query, shard_rows, block_rows)
    kind = table.schema[key].dataType.simpleString()

    def tile(group: tuple, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        asked, near, cost = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if candidates.num_rows and queries.num_rows:
            ids, vectors = matrix(candidates)
            vectors = np.floor(scale * vectors)
            firsts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            query_ids, query_vectors = matrix(queries)
            query_vectors = np.floor(scale * query_vectors)
            for begin in range(0, len(query_ids), rows_at_once):
                some = slice(begin, begin + rows_at_once)
                scores = products(query_vectors[some], vectors)
                if len(firsts) < len(ids):  # an id with several vectors has the best of their scores
                    scores = np.maximum.reduceat(scores, firsts, axis=1)
                for query, own_scores in zip(query_ids[some], scores):
                    found, value = top(ids[firsts], own_scores, query, k)
                    asked.append(np.full(len(found), query))
                    near.append(found)
                    cost.append(-value)
        asked_ids = np.concatenate(asked)
        part = np.full(len(asked_ids), group[1].as_py(), np.int32)
        return pa.table(
            {"query_id": asked_ids, "part": part, "vec_id": np.concatenate(near), "cost": np.concatenate(cost)}
        )

    found = grid.applyInArrow(tile, f"query_id {kind}, part int, vec_id {kind}, cost long")
    return merged(found, shards, k).select("query_id", "rank", "vec_id", (-F.col("cost")).alias("score"))


def sql(every: int = 50, k: int = 5, scale: int = 256) -> str:
    """The same on a table ``embeddings`` (vec_id unique, embedding) in SQL; queries: ids divisible by ``every``."""
    return f"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % {every} = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {k}
"""
