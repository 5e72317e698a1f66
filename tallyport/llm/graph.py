"""Connected components by alternating stars: joins and minimums only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyport.llm.tables import written


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every linked node; component is the least node reachable.

    Each round hangs the larger neighbours of a node on its least neighbour, then the
    smaller ones. A node with very many links is reduced by a partial minimum, and the join
    that follows can be split by Spark. Loops and repeated links are harmless, null ends are
    ignored. The edges are written after each round, so a lost executor repeats one round.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = written(edges, "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        small = large.join(_least(large), "u")
        edges = written(
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "edges",
        )
        # done when every node hangs on one other, on which nothing more hangs
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        state = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if state.where("up > 1 or (up = 1 and down = 1)").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
