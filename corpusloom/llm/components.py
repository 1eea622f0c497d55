"""Connected components of a graph given as edges, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.runtime import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) to (u, v) with v the smallest node of u's component; smallest nodes have no row.

    Large and small stars in turn: every node hangs its larger, then its smaller
    neighbours on the smallest node it knows, until nothing changes. Each round is written
    to the shared folder; rounds grow with the logarithm of the longest path.
    """
    near = Window.partitionBy("u")
    stars = checkpoint(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            return stars
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least(F.min("v").over(near), F.col("u"))).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.filter("u != v").distinct().withColumn("m", F.min("v").over(near))
        small = low.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = checkpoint(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
