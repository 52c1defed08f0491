"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def _towards_least(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (hi, lo): hang neighbours of each node below its least neighbour."""
    if large:
        ends = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    else:
        ends = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    told = ends.join(least, "u")
    if large:
        new = told.where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        new = told.select(F.col("v").alias("hi"), F.col("m").alias("lo")).union(least.select("u", "m"))
    return new.where("hi > lo").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, comp): for every node on an edge the least node that its edges lead to.

    Every pass is a few joins and aggregations; all that reaches the driver is one row with a count and a checksum.
    """
    now = materialize(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct(),
        "edges",
    )
    state = lambda d: tuple(d.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("hi", "lo"), F.lit(1 << 40)))).first())
    before = state(now)
    while before[0]:
        now = materialize(_towards_least(_towards_least(now, True), False), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    # at rest every edge leads straight to the least node of its component
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).union(now.select("lo", "lo").distinct())
