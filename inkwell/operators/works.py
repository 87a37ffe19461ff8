"""Works: texts that belong together, under complete link."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.graph import connected_components
from inkwell.session import drop_stored, stored

#: Edges of a component that one task settles; larger components are settled in rounds.
SETTLED = 2_000_000


def complete_link(edges: DataFrame, most: int = SETTLED) -> DataFrame:
    """GD6: clusters in which every two nodes have an edge, grown in the order of the edges: node, cluster.

    Edges are distinct pairs left < right. They are taken by (left, right); the clusters of an edge's ends merge if all
    pairs between them are edges, that is, if there are as many edges as pairs. A pair of clusters that fails once never merges later,
    as its missing pair stays, so edges between different clusters of the result are the rejected ones.

    A component of up to ``most`` edges is settled by one task, whose memory that bounds. In larger ones each round merges
    the pairs of clusters whose first edge comes before that of any other mergeable pair of either side: nothing before
    it in the order can touch them, so the result is the same. A cluster is named by its smallest node; nodes
    without edges are not listed; without edges the result is empty.
    """
    pairs = stored(edges.where("left < right").select("left", "right").distinct(), "links")
    parts = connected_components(pairs, "left", "right")
    placed = stored(pairs.join(parts.withColumnRenamed("node", "left"), "left").select("component", "left", "right"), "placed-links")
    counted = placed.groupBy("component").agg(F.count("*").alias("links"))
    small, large = (placed.join(counted.where(test).select("component"), "component", "left_semi") for test in (F.col("links") <= most, F.col("links") > most))
    settled = small.groupBy("component").applyInArrow(_settle, "node long, cluster long")
    return settled.union(_rounds(large.select("left", "right"))) if not large.isEmpty() else settled


def _settle(table: pa.Table) -> pa.Table:
    """One component, edge by edge."""
    ordered = table.sort_by([("left", "ascending"), ("right", "ascending")])
    links = list(zip(ordered["left"].to_pylist(), ordered["right"].to_pylist(), strict=True))
    cluster = {node: node for link in links for node in link}
    members = {node: [node] for node in cluster}
    between: dict[int, dict[int, int]] = {node: {} for node in cluster}
    for left, right in links:
        between[left][right] = between[right][left] = 1
    for left, right in links:
        a, b = cluster[left], cluster[right]
        if a == b or between[a][b] < len(members[a]) * len(members[b]):
            continue
        if len(between[a]) + len(members[a]) < len(between[b]) + len(members[b]):
            a, b = b, a
        for node in members[b]:
            cluster[node] = a
        members[a] += members.pop(b)
        for other, count in between.pop(b).items():
            del between[other][b]
            if other != a:
                between[a][other] = between[other][a] = between[a].get(other, 0) + count
    least = {name: min(nodes) for name, nodes in members.items()}
    return pa.table({"node": pa.array(list(cluster), pa.int64()), "cluster": pa.array([least[name] for name in cluster.values()], pa.int64())})


def _rounds(edges: DataFrame) -> DataFrame:
    """The same by rounds over a table of cluster pairs with the number of edges between them and the first one."""
    ends = edges.select(F.explode(F.array("left", "right")).alias("node")).distinct()
    member = stored(ends.select("node", F.col("node").alias("cluster")), "members")
    pairs = stored(edges.select(F.col("left").alias("a"), F.col("right").alias("b"), F.lit(1).cast("long").alias("n"), F.struct("left", "right").alias("first")), "pairs")
    while True:
        sizes = member.groupBy("cluster").agg(F.count("*").alias("size"))
        of_a, of_b = (sizes.select(F.col("cluster").alias(side), F.col("size").alias(f"size_{side}")) for side in ("a", "b"))
        full = stored(pairs.join(of_a, "a").join(of_b, "b").where(F.col("n") == F.col("size_a") * F.col("size_b")).select("a", "b", "first"), "mergeable")
        if full.isEmpty():
            for done in (pairs, full):
                drop_stored(done)
            return member
        best = full.select(F.explode(F.array("a", "b")).alias("cluster"), "first").groupBy("cluster").agg(F.min("first").alias("first"))
        chosen = full.join(best.withColumnRenamed("cluster", "a"), ["a", "first"]).join(best.withColumnRenamed("cluster", "b"), ["b", "first"])
        into = stored(chosen.select(F.col("b").alias("old"), F.col("a").alias("new")), "merges")
        after = stored(member.join(into, member["cluster"] == into["old"], "left").select("node", F.coalesce("new", "cluster").alias("cluster")), "members")
        renamed = pairs
        for side in ("a", "b"):
            moved = into.select(F.col("old").alias(side), F.col("new").alias(f"new_{side}"))
            renamed = renamed.join(moved, side, "left").withColumn(side, F.coalesce(f"new_{side}", side)).drop(f"new_{side}")
        left = renamed.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("n").alias("n"), F.min("first").alias("first"))
        left = stored(left, "pairs")
        for done in (member, pairs, full, into):
            drop_stored(done)
        member, pairs = after, left


def catalogue(members: DataFrame, relations: DataFrame, automatic: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """GD6: the works of a catalogue, and the edges that it keeps.

    ``members`` are rows id, head, quality (a struct that orders descending), where head is the smallest id of equal texts;
    ``relations`` are pairs left < right of heads with their relation, "distinct" ones left out.

    Works are rows id, work, edition, action, version. A work is a cluster of heads under complete link over automatic
    relations, named by its smallest id; its editions are the components of the same_edition relation inside it. The
    best row of the work is canonical, the best of each other edition is an edition, all others are source_duplicate.
    Versions number a work's editions, the canonical one first, then by their best rows. Edges are left, right, relation, automatic; an
    automatic one between different works becomes transitive_conflict, for review. Rows without head are left out.
    """
    links = relations.where(F.col("relation").isin(*automatic))
    clusters = stored(complete_link(links), "clusters")
    of = lambda side: clusters.select(F.col("node").alias(side), F.col("cluster").alias(f"{side}_work"))
    known = relations.join(of("left"), "left", "left").join(of("right"), "right", "left")
    together = F.coalesce(F.col("left_work") == F.col("right_work"), F.lit(False))
    auto = F.col("relation").isin(*automatic)
    edges = known.select("left", "right", F.when(auto & ~together, "transitive_conflict").otherwise(F.col("relation")).alias("relation"), (auto & together).alias("automatic"))
    same = edges.where("automatic AND relation = 'same_edition'")
    editions = connected_components(same, "left", "right")
    heads = members.where("head IS NOT NULL")
    named = heads.join(clusters.withColumnRenamed("node", "head"), "head", "left").join(editions.withColumnRenamed("node", "head"), "head", "left")
    placed = stored(named.select("id", F.coalesce("cluster", "head").alias("work"), F.coalesce("component", "head").alias("edition"), "quality"), "placed")
    best = placed.groupBy("work", "edition").agg(F.max(F.struct("quality", (-F.col("id")).alias("id"))).alias("best"))
    version = F.row_number().over(Window.partitionBy("work").orderBy(F.desc("best")))  # of each edition one row
    numbered = best.select("work", "edition", (-F.col("best.id")).alias("chosen"), version.alias("version"))
    action = F.when(F.col("id") != F.col("chosen"), "source_duplicate").when(F.col("version") == 1, "canonical").otherwise("edition")
    return placed.join(numbered, ["work", "edition"]).select("id", "work", "edition", action.alias("action"), "version"), edges
