"""Connected components of a graph of links, in Spark alone.

Alternating *large-star* and *small-star* steps: each node's links are moved to the smallest
node it knows, which leaves every component a star round its smallest node after a number of
steps that grows with the logarithm of its size. The minima are aggregated map-side first, and
each pair of steps is written to the shared folder: nothing of the graph reaches the driver but
its counts, and a lost executor costs at most one pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node, linked to the node's smallest (itself included)."""
    both = links.union(links.select("v", "u"))
    lowest = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    return both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours, linked to the smallest of them.

    After a large step few different ones are left for a node, so a window over them is small."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    lowest = down.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    return lowest.selectExpr("inline(array(struct(v AS u, m AS v), struct(u AS u, m AS v)))")


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); a component is its smallest node."""
    now = written(links.where("u != v").select("u", "v").distinct(), "links")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)).where("u != v").distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(now.select(F.col("v"), F.col("v"))).distinct()
