"""Connected components by alternating large-star and small-star, on DataFrames.

Edges lead from the larger node u to the smaller node v.  Minima are combined before they are dealt out, and written
before they are joined back, so a node with very many neighbours is a skewed join, which Spark splits, and never one
group in one task.  Neither step makes more edges than it was given, so repeated edges need no distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def large_star(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """Joins every larger neighbour of a node to the smallest of the node and its neighbours.  bent: to another one."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m")).select("at", F.least("at", "m").alias("m"))
    least = ws.put(least, name)
    to = edges.select(F.col("v").alias("at"), "u").join(least.hint("merge"), "at")
    return to.select("u", F.col("m").alias("v"), (F.col("m") != F.col("at")).alias("bent"))


def small_star(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """Joins a node and its smaller neighbours to the smallest of them.  bent: a neighbour that wasn't the smallest."""
    least = ws.put(edges.groupBy("u").agg(F.min("v").alias("m")), name)
    moved = edges.select("u", "v").join(least.hint("merge"), "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("bent"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"), F.lit(False).alias("bent")))


def components(links: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(a, b) links to (node, component): the smallest node reachable, for every node that reaches a smaller one."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v"))
    edges, some = ws.counted(edges, f"{name}-0")
    turn, bent = 0, some["n"]
    while bent:
        turn, bent = turn + 1, 0
        for step, star in (("l", large_star), ("s", small_star)):
            edges, seen = ws.counted(star(edges, ws, f"{name}-least"), f"{name}-{turn}{step}", n=F.count_if("bent"))
            bent += seen["n"]
            ws.drop(f"{name}-least")
        ws.drop(f"{name}-{turn}l")
        ws.drop(f"{name}-{turn - 1}{'s' if turn > 1 else ''}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
