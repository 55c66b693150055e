"""Connected components of links by alternating large and small stars; labels never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least.select(F.col("a").alias("of"), "m"), F.col("a") == F.col("of")).filter("b <> m")
    return others.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (a, b) but the roots themselves; the root is a component's least node."""
    edges = stored(links.select("a", "b").filter("a <> b").distinct())
    state = None
    while True:
        stars = _small_star(_large_star(edges)).filter("a <> b").distinct()
        edges = stored(stars)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
