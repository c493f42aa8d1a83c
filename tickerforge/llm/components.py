"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerforge.llm.common import Stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on its least neighbour (itself counted)."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours and itself on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (u, v); root is the least node of its component.

    Every round is written to the shared folder, so that lineage stays short and a lost executor
    repeats one round at most. Rounds grow with the logarithm of the largest component.
    """
    now = Stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        after = Stored(_small_star(_large_star(now.df)), "edges")
        mark = after.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now.drop()
        now = after
        if mark == seen:
            break
        seen = mark
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
