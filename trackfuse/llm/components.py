"""Connected components of a graph given by its edges, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackfuse.session import stage


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Join each node's larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours to the smallest of them."""
    least = _smallest(edges)
    others = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (u, v: numbers) that is not its own root; the root is the smallest.

    Alternates large-star and small-star steps (Kiveris et al., "Connected components in
    MapReduce and beyond", 2014) until nothing changes; each step is written, so lineage
    stays short. Loops and repeated edges are ignored.
    """
    edges = (
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    edges, before = stage(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now.n:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        edges = stage(_small_star(_large_star(edges)), "edges")
