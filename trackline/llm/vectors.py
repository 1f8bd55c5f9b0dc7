"""What the vector searches share: usable rows, tiles of queries and candidates, and merging of top lists.

A tile is a block of queries and a shard of candidates, both of bounded size. Rows are dealt to
shards and blocks at random, whatever their ids, so repeated ids cannot fill a tile. Only vectors of one length meet.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(table: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """id, v and dim of rows with an id and a vector of finite components; ``zero``: vectors of zeros too."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = table.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False))
    )
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.withColumn("dim", F.size("v"))


def tiles(rows: DataFrame, is_query: Column, shard_rows: int, block_rows: int):
    """Candidates and queries, each grouped by dim, shard and block for a cogroup; and the number of shards."""
    count, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-count // shard_rows)), max(1, -(-asked // block_rows))
    by = ["dim", "shard", "block"]
    candidates = rows.withColumn("shard", F.floor(F.rand(1) * shards).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    queries = (
        rows.where(is_query)
        .withColumn("block", F.floor(F.rand(2) * blocks).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    return candidates.groupBy(*by).cogroup(queries.groupBy(*by)), shards


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (as doubles) of a tile's rows, by id and then by vector."""
    table = table.combine_chunks()
    ids = table.column("id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(ids), -1)
    order = np.lexsort([*rows.T[::-1], ids])
    return ids[order], rows[order]


def best(ids: np.ndarray, costs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k least costs with their ids, ties to smaller ids; an id counts once, with its least cost."""
    if len(costs) > k:
        # all that may be among the first k distinct ids, ties included
        distinct = min(len(costs), k * 4)
        limit = np.partition(costs, distinct - 1)[distinct - 1]
        some = costs <= limit
        if len(np.unique(ids[some])) >= k:
            ids, costs = ids[some], costs[some]
    order = np.lexsort([ids, costs])
    ids, costs = ids[order], costs[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], costs[first]


def merged(found: DataFrame, lists: int, k: int, fan_in: int = 32) -> DataFrame:
    """Per query the k least costs of all its lists, from a tree of merges: query_id, rank, vec_id, cost.

    ``found`` has query_id, part (the number of the list, below ``lists``), vec_id and cost.
    """
    rows = found.groupBy("query_id", "vec_id").agg(F.min(F.struct("cost", "part")).alias("least"))
    rows = rows.select("query_id", "vec_id", "least.cost", "least.part")
    while True:
        lists = -(-lists // fan_in)
        group = F.floor(F.col("part") / fan_in).cast("int") if lists > 1 else F.lit(0)
        ordered = F.array_sort(F.collect_list(F.struct("cost", "vec_id")))  # at most fan_in * k rows
        tops = rows.groupBy("query_id", group.alias("part")).agg(F.slice(ordered, 1, k).alias("top"))
        if lists == 1:
            ranked = tops.select("query_id", F.posexplode("top").alias("at", "hit"))
            return ranked.select("query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.cost")
        rows = tops.select("query_id", "part", F.explode("top").alias("hit")).select(
            "query_id", "part", "hit.vec_id", "hit.cost"
        )
