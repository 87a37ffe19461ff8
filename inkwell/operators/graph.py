"""Graphs as edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.session import drop_stored, stored


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Smallest reachable node of every node that has an edge: columns node, component.

    Alternates large-star and small-star steps until the edges no longer change.
    Minima are aggregated before the shuffle, and the join of a hub's edges with
    its one minimum is an ordinary join that adaptive execution splits, so a hub
    of any size never meets in one task. Each round's edges are written to the
    shared folder. Loops, repeated edges and nulls are left out; without edges the
    result is empty.
    """
    a, b = F.col(left), F.col(right)
    pairs = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now, before = stored(pairs.distinct(), "edges"), None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v")).distinct()
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.union(least).distinct(), "edges")
        drop_stored(now)
        now, before = after, mark
