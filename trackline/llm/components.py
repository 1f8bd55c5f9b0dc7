"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trackline.session import materialized


def stars(links: DataFrame) -> DataFrame:
    """Each node of ``links`` (two columns of one type) but the least of its component, with that least node.

    Columns node and root. Large-star and small-star steps in turn: each node's neighbours are linked
    to the least of them, which halves paths, until nothing changes. No step gathers the neighbours
    of a node; a node with very many of them is one row of an aggregate and a join that can be split.
    """
    one, other = links.columns
    edges = links.select(F.greatest(one, other).alias("u"), F.least(one, other).alias("v")).where("u > v").distinct()
    edges, before = materialized(edges), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        edges = materialized(_small_star(_large_star(edges)))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()
