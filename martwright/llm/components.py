"""Connected components of an edge table by alternating star operations.

Each round points every node at the smallest node it knows of (large star: its greater
neighbours; small star: itself and its smaller ones) until nothing changes, which takes
about the logarithm of the longest chain. Minima are pre-aggregated before a shuffle, so
a node with most of the edges costs one row a task. Rounds are cut by checkpoint() into
the folder that the executors share.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import shared_folder


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    large = large.distinct()
    least = large.groupBy("u").agg(F.min("v").alias("least"))
    small = large.join(least, "u")
    pointed = small.select(F.col("u"), F.col("least").alias("v"))
    passed = small.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return pointed.unionByName(passed).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (its component's smallest node) for every node of the edges
    (u, v), in any order and repeated or not; nodes without an edge are not returned."""
    spark = edges.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    ordered = edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    stars = ordered.distinct().checkpoint()
    seen = _fingerprint(stars)
    while seen[0]:
        stars = _stars(stars).checkpoint()
        now = _fingerprint(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("v").alias("u"), "v").distinct()
    return stars.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
