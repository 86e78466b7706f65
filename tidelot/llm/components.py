"""Connected components of an edge list, by alternating large and small stars.

Each round is two shuffles of the edges and is written to the shared folder, so lost executors repeat one round at
most. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelot.llm.common import saved


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges ``(u, v)`` with u > v.

    Large: every larger neighbour of a node is hung under the least of its neighbours and itself. Small: a node and
    its smaller neighbours are hung under the least of these.
    """
    seen = edges.union(edges.select("v", "u")) if large else edges
    least = seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = seen.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)`` that is not itself a root; the root is the least node."""
    now = saved(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(now)
    while before[0]:
        now = saved(_stars(_stars(now, True), False), "stars")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
