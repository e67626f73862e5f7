"""Connected components of a links table by alternating large and small stars.

Every round is two joins and grouped minima; rounds follow the logarithm of
the longest path.  Each round is written to the shared folder, so a lost
executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least one."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    return (near.filter(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("node"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node (a) and its smaller neighbours (b) are linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    moved = joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label): the least node of the component of every node that has a
    link.  `links`: (a, b) of longs, either way round; loops and links with a
    null end are ignored, and no links give no rows."""
    now = written(spark, links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")
    mark = None
    while True:
        # stars are reached when neither the number of links nor their sums change
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(seen) == mark or not seen["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
        mark = tuple(seen)
        now = written(spark, _small_star(_large_star(now)), "links")
