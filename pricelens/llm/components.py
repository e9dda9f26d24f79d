"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.session import materialise


#: Edges that a task takes at least: a few thousand edges are not worth hundreds of tasks a round.
TASK_EDGES, LEAST_TASKS = 100_000, 8


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``edges`` (longs ``a, b``); the component is its smallest id.

    Each round hangs the greater neighbours of every id on its smallest neighbour, then the smaller ones, and writes
    the edges that are left; a logarithmic number of rounds leaves stars. Ids with many edges only meet in partial
    minima and in joins that adaptive execution can split. The tasks of a round follow from the number of edges.
    """
    seen, tasks = None, max(LEAST_TASKS, math.ceil(edges.count() / TASK_EDGES))
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialise(ordered.distinct().coalesce(tasks), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).coalesce(tasks).distinct().coalesce(tasks)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a").coalesce(tasks)
        small = hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")).coalesce(tasks)).distinct()
        links = materialise(small.coalesce(tasks), "links")
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
