"""Connected components of a link table by alternating star contraction.

Each round points larger ids at smaller ones (large star, then small star), with joins and map-side minima only;
no vertex's neighbours are gathered in a task and nothing but two counters reaches the driver. Links are few beside the texts
they come from, so the steps of a round run in as many tasks as the links need, not in one per shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from specloom.llm.common import materialize

LINKS = 100_000  # links of a task, on average; with fewer, each core gets one task


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("lowest"))


def _round(edges: DataFrame, tasks: int) -> DataFrame:
    """One large star and one small star over links ``hi > lo``, each step in at most ``tasks`` tasks."""
    marks = _lowest(edges)
    large = (edges.join(marks, edges.lo == marks.node, "left").select("hi", F.coalesce("lowest", "lo").alias("lo"))
             .coalesce(tasks).distinct().coalesce(tasks))
    marks = _lowest(large)
    small = large.join(marks, large.hi == marks.node).where(F.col("lo") > F.col("lowest"))
    return (small.select(F.col("lo").alias("hi"), F.col("lowest").alias("lo"))
            .unionByName(marks.select(F.col("node").alias("hi"), F.col("lowest").alias("lo"))).coalesce(tasks).distinct().coalesce(tasks))


def components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component`` for each node from which a smaller id can be reached; component is the smallest such id.

    Links are undirected; links with a null end, of a node to itself and repeated ones change nothing. A table
    without links gives no rows. The number of rounds grows with the logarithm of the longest path.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    edges = materialize(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), a.isNotNull() & b.isNotNull())
                        .toDF("hi", "lo", "whole").where("whole and hi > lo").select("hi", "lo").distinct())
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-edges.count() // LINKS))
    edges = edges.coalesce(tasks)
    while _unfinished(edges, tasks):
        edges = materialize(_round(edges, tasks))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def _unfinished(edges: DataFrame, tasks: int) -> bool:
    """Whether some node points at two others, or at one and is pointed at; otherwise all links are stars."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    several = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1")
    return bool(several.coalesce(tasks).take(1))
