"""Connected components of an edge table by alternating large-star and small-star steps.

Every step moves each node's neighbours to the smallest node known around it;
the number of rounds grows with the logarithm of the longest path, and ends when
all links form stars.  Each round is written to the shared folder, so no plan
grows and lost executors re-read files.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import saved


def _least(links: DataFrame) -> DataFrame:
    """(u, v, m): every link u-v with the least of u and all its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return links.join(least, "u")


def _settled(links: DataFrame) -> bool:
    """Whether the links (u, v), each with v < u, are stars: every u has one v, and no v is a u."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("centre")).unionAll(
        links.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("centre").alias("centre"))
    return nodes.filter("below > 1 or (below = 1 and centre = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the least node reachable; nodes are those of ``edges`` (a, b)."""
    now = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct(), "edges")
    while not _settled(now):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _least(large.filter("u <> v").distinct())
        joined = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            small.filter("u <> m").select("u", F.col("m").alias("v")))
        now = saved(joined.distinct(), "stars")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.withColumn("component", F.col("node")))
