"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.common import written


def stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: neighbours of a node point to the least node around it.

    Large stars move neighbours above the node, small stars those below it. Minima are
    aggregated before the join, so a node of many edges is no group of many rows.
    """
    u, v = F.col("u"), F.col("v")
    ends = F.array(F.struct(u.alias("u"), v.alias("v")), F.struct(v.alias("u"), u.alias("v")))
    both = edges.select(F.explode(ends).alias("end")).select("end.u", "end.v")
    around = both if larger else both.where(v < u)
    least = around.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("least", "u").alias("least"))
    joined = around.join(least, "u")
    if larger:
        moved = joined.where(v > u).select(v.alias("u"), F.col("least").alias("v"))
    else:
        moved = joined.select(v.alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v"))
        )
    return moved.where(u != v).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node) of every node of ``edges`` (``u, v``, integers).

    Large and small stars take turns until nothing moves; the number of rounds grows with
    the logarithm of the nodes. Each star is written, so none is computed twice and the plan of
    a step stays as small as that of the first.
    """
    now = written(edges.where("u != v").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = written(stars(written(stars(now, True), "edges"), False), "edges")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
