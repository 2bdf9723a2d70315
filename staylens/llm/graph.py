"""Connected components of an edge table, by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b): component is the
    smallest id that can be reached. Each round links every node to the smallest
    neighbour of its larger, then of its smaller neighbours, and writes the
    edges to the shared folder; the number of rounds grows with the logarithm
    of the longest chain. Minima are pre-aggregated, so hubs are no hot spots."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        down = large.unionByName(edges.join(low.select(F.col("a").alias("b"), "m"), "b")
                                 .select("a", F.col("m").alias("b")).where("a <> b")).distinct()
        down = stored(down, "stars")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    tops = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(tops)
