"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.storage import written

#: The tasks that write a step of a round: so many, or more with more than ``TASK_LINKS`` links for each.
TASKS, TASK_LINKS = 16, 200_000


def _neighbours_to_least(pairs: DataFrame, tasks: int) -> DataFrame:
    """(node, neighbour, least of the node and its neighbours) for directed ``pairs`` (u, v)."""
    # Grouped by one value and joined by another, so that a node with very many links is split.
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks).select(F.bitwise_not("u").alias("w"), "m")
    joined = pairs.select(F.bitwise_not("u").alias("w"), "u", "v").join(least, "w").coalesce(tasks)
    return joined.select("u", "v", F.least("u", "m").alias("m"))


def _are_stars(edges: DataFrame) -> tuple[int, bool]:
    """How many links there are, and whether every node with a lesser one has no other link: its component is a star then."""
    ends = F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).cast("long").alias("upper")),
        F.struct(F.col("v").alias("node"), F.lit(0).cast("long").alias("upper")),
    )
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("upper").alias("upper"), F.count("*").alias("n"))
    count, bound = nodes.agg(F.sum("upper"), F.max((F.col("upper") > 0) & (F.col("n") > 1))).first()
    return count or 0, not bound


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node in ``links`` (a, b).

    Links are longs and may repeat or point both ways. Each round reduces every
    neighbourhood to a star around its least node; the rounds grow with the
    logarithm of the longest path, and end as soon as all links are stars. Links are few and small next to what they
    come from, so the tasks that write for the next step go by the links: a file for each of the session's partitions, in
    every shuffle of every round, would take more disk than the links do.
    """
    # Written before the first round as well: the optimizer would multiply the conditions of a lazy one.
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    count, stars = _are_stars(edges)
    tasks = max(TASKS, count // TASK_LINKS)
    while not stars:
        # Both ways by one generator, not a union: each round joins its links with themselves twice, and the driver
        # would plan, compile and report every branch of every union again.
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        large = _neighbours_to_least(both, tasks).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _neighbours_to_least(large.distinct().coalesce(tasks), tasks)
        found = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        edges = written(small.select(F.inline(found)).where("u != v").distinct().coalesce(tasks))
        _, stars = _are_stars(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
