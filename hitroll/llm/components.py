"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitroll.llm.common import cut, discard


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return (both.join(low, "a").where("b > a and b <> low")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = (down.join(low, "a").where("b <> low")
             .select(F.col("b").alias("a"), F.col("low").alias("b")))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges`` (a, b).

    Every round writes its edges to the shared scratch folder. A star's centre gets one partial
    minimum per task, so a node with very many links is not gathered in one place.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        before, edges = edges, cut(_small_star(_large_star(edges)), "edges")
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
