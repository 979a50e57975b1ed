"""Connected components by alternating large-star and small-star steps.

The published map-reduce scheme: each step replaces edges by edges to the
smallest neighbour, and the number of steps is logarithmic. Every step is a
map-side combined minimum and a join, both of which split hot nodes, and is
written to the shared folder, so a lost executor repeats one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.session import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v): large links the larger neighbours of u to the
    smallest one, small links u and its smaller neighbours to it."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for every node that an edge to another node touches; the
    label is the smallest node of its component. Edges with a null end, loops
    and repeats do not matter; no edges give no rows."""
    pair = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = written(pair.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        nxt = written(_star(_star(now, True), False), "edges")
        after = _state(nxt)
        now, done = nxt, after == state
        state = after
        if done:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
