"""Connected components of a graph whose links are a table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.scratch import settle

# Links that one task takes at most.
TASK_LINKS = 200_000


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked to by any path, for links (a, b).

    Alternates two steps on the table of links: all larger neighbours of a node are linked to its smallest
    neighbour, then the same for the smaller ones. Every step groups by node and needs the minimum alone, so
    that a node with many links is aggregated before it is shuffled. The number of rounds grows with the
    logarithm of the longest path.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        # the table is stable when a round gives the same links
        state = edges.agg(
            F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
        # links are narrow: a small graph is not worth many tasks
        tasks = math.ceil(state[0] / TASK_LINKS) or 1
        edges = settle(_to_smallest(_to_smallest(edges, True, tasks), False, tasks))
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _to_smallest(edges: DataFrame, larger: bool, tasks: int) -> DataFrame:
    edges = edges.coalesce(tasks)
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
    both = both.coalesce(tasks)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")).coalesce(tasks)
    joined = both.join(least, "a").coalesce(tasks)
    if larger:
        linked = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return linked.filter("a <> b").distinct().coalesce(tasks)
