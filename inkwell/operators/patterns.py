"""Patterns across books: terms, neighbours, support, merges, promotion, graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.catalog import ranks
from inkwell.operators.leaders import followers
from inkwell.operators.overlaps import close_pairs, near_sets
from inkwell.session import stored


def nearest(pairs: DataFrame, keys: list[str], k: int, score: str = "jaccard") -> DataFrame:
    """The ``k`` best right sides of each left side; ties go to the smaller id."""
    order = Window.partitionBy(*keys, "left").orderBy(F.desc(score), F.asc("right"))
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def relation_score(shared_chunks: Column, jaccard: Column, same_book: Column) -> Column:
    """How related two patterns are; evidence alone stays below the line of 0.7."""
    score = 0.6 * F.least(F.lit(1.0), shared_chunks / 2) + 0.3 * jaccard + F.when(same_book, 0.1).otherwise(0.0)
    return F.when((jaccard == 0) & (score >= 0.7), 0.6999).otherwise(score)


def support(instances: DataFrame, pattern: str, book: str) -> DataFrame:
    """Books and instances behind each pattern."""
    return instances.groupBy(pattern).agg(F.countDistinct(book).alias("books"), F.count("*").alias("instances"))


def pattern_quality(named: Column, instances: Column, books: Column, slots: Column, conditions: Column, axes: Column, usage: Column, risks: Column) -> Column:
    """The additive quality of a pattern."""
    return (
        F.when(named, 0.24).otherwise(0.0)
        + F.when(instances >= 8, 0.20).when(instances >= 3, 0.12).when(instances >= 1, 0.04).otherwise(0.0)
        + F.when(books >= 3, 0.16).when(books == 2, 0.10).when(books == 1, 0.04).otherwise(0.0)
        + F.when(slots >= 2, 0.14).when(slots == 1, 0.06).otherwise(0.0)
        + F.when((conditions >= 2) & (axes >= 2), 0.14).when((conditions > 0) | (axes > 0), 0.06).otherwise(0.0)
        + F.when(usage & risks, 0.08).otherwise(0.0)
        + F.when(instances >= 3, 0.04).otherwise(0.0)
    )


def pattern_status(rejected: Column, duplicate: Column, quality: Column, books: Column, instances: Column) -> Column:
    """What becomes of a pattern, tests in order."""
    return (
        F.when(rejected, "rejected").when(duplicate >= 0.88, "near_duplicate").when(quality < 0.72, "low_quality")
        .when((books >= 3) & (instances >= 8), "universal").when(instances >= 3, "emerging").otherwise("rejected")
    )


def candidate_tier(abstraction: Column, reuse: Column, specificity: Column, dependency: Column, complete: Column) -> Column:
    """Confidence and tier of a candidate."""
    confidence = F.when(complete, 0.42 * abstraction + 0.33 * reuse + 0.15 * specificity + 0.10 * (1 - dependency)).otherwise(0.0)
    tier = F.when(~complete, "rejected").when(confidence >= 0.75, "seed").when(confidence >= 0.55, "candidate").otherwise("raw")
    return F.struct(confidence.alias("confidence"), tier.alias("tier"))


def promotion(books: Column, instances: Column, variants: Column, open_issues: Column) -> Column:
    """Whether a pattern may be promoted."""
    return (books >= 3) & (instances >= 8) & (variants >= 2) & (open_issues == 0)


def role_support(instances: DataFrame, pattern: str, roles: str, most: int = 2, least: float = 0.5) -> DataFrame:
    """Share of a pattern's instances that fill each role; the ``most`` frequent ones from ``least`` on."""
    total = instances.groupBy(pattern).agg(F.count("*").alias("total"))
    counted = instances.select(pattern, F.explode(F.array_distinct(roles)).alias("role")).groupBy(pattern, "role").agg(F.count("*").alias("n"))
    shares = counted.join(total, pattern).withColumn("ratio", F.col("n") / F.col("total"))
    order = Window.partitionBy(pattern).orderBy(F.desc("ratio"), "role")
    return shares.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= most) & (F.col("ratio") >= least)).select(pattern, "role", "ratio")


def divergence(instances: DataFrame, pattern: str) -> DataFrame:
    """Whether a pattern's instances (id, terms, state) differ so much that it should be split.

    Pairs are counted in blocks of instances, two to a task, and never made.
    """
    basic = instances.groupBy(pattern).agg(F.count("*").alias("n"), F.countDistinct("state").alias("states"))
    close = close_pairs(instances, pattern, 0.08)
    pairs = F.col("n") * (F.col("n") - 1) / 2
    share = F.when(pairs == 0, 0.0).otherwise(1 - F.coalesce("close", F.lit(0)) / pairs)
    return basic.join(close, pattern, "left").select(pattern, "n", "states", share.alias("apart"), ((F.col("n") >= 4) & (F.col("states") >= 3) & (share >= 0.65)).alias("split"))


def graph(rows: DataFrame, book: str, order: str, text_node: Column, kind: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of ordered rows: each row, the node that it raises, and what comes next.

    A node that several rows raise keeps the order of the first; edges are typed.
    """
    by_order = Window.partitionBy(book).orderBy(order)
    base = rows.select(F.col(book).alias("book"), F.col(order).alias("order"), text_node.alias("raised"), F.lead(order).over(by_order).alias("after"))
    plot = F.concat(F.lit("plot:"), F.col("book").cast("string"), F.lit(":"), F.col("order").cast("string"))
    other = F.concat(F.lit(f"{kind}:"), F.sha1("raised"))
    nodes = base.select("book", plot.alias("node"), F.lit("plot").alias("type"), "order").union(
        base.where("raised IS NOT NULL").groupBy("book", other.alias("node")).agg(F.min("order").alias("order")).select("book", "node", F.lit(kind).alias("type"), "order")
    )
    following = F.concat(F.lit("plot:"), F.col("book").cast("string"), F.lit(":"), F.col("after").cast("string"))
    edges = base.where("after IS NOT NULL").select("book", plot.alias("source"), following.alias("target"), F.lit("next").alias("type")).union(
        base.where("raised IS NOT NULL").select("book", plot.alias("source"), other.alias("target"), F.lit("raises").alias("type"))
    )
    return nodes, edges.distinct()


def first_wins(rows: DataFrame, group: str, order: str, mapping: str) -> DataFrame:
    """Union of maps where the first row with a key gives its value."""
    entries = rows.select(group, order, F.explode(mapping).alias("key", "value"))
    kept = entries.groupBy(group, "key").agg(F.min_by("value", order).alias("value"))
    return kept.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias(mapping))


def summed_usage(rows: DataFrame, group: str, mapping: str) -> DataFrame:
    """Sums of numbers by key over maps."""
    return rows.select(group, F.explode(mapping).alias("key", "value")).groupBy(group, "key").agg(F.sum("value").alias("value"))


def suppressed(rows: DataFrame, library: str, name: str, support_col: str, terms: str, limit: float = 0.88) -> DataFrame:
    """Greedy suppression within each library, strongest first: adds cluster, the name that a row falls to.

    Equal term sets fall together. Sets are numbered in their order, so pairs are two numbers and the smaller one is the stronger;
    a set falls to the first of those that stay and are near to it. Names are unique in a library.
    """
    known = F.array_sort(F.array_distinct(terms))
    keyed = stored(rows.withColumn("__id", F.unhex(F.sha2(F.to_json(F.struct(library, known.alias("__terms"))), 256))), "patterns")
    order = F.struct(F.col(library).alias("library"), (-F.col(support_col)).alias("strength"), F.col(name).alias("name"))
    firsts, _ = ranks(keyed.where(F.size(terms) > 0).groupBy("__id").agg(F.min(order).alias("order")), "order")
    firsts = stored(firsts.select("__id", F.col("rank").alias("id"), F.col("order.name").alias("first")), "firsts")
    sets = keyed.join(firsts, "__id").where(F.col(name).eqNullSafe(F.col("first")))
    sets = stored(sets.select("id", F.col(library).alias("group"), known.alias("terms")), "sets")
    near = stored(near_sets(sets, limit).where("left < right").select("left", "right"), "near")
    follow = stored(followers(near, unique=True), "followers")
    falls = near.join(follow.withColumnRenamed("id", "right"), "right", "left_semi").join(follow.withColumnRenamed("id", "left"), "left", "left_anti")
    falls = falls.groupBy(F.col("right").alias("id")).agg(F.min("left").alias("to"))
    to = firsts.select(F.col("id").alias("to"), F.col("first").alias("__to"))
    cluster = firsts.join(falls.join(to, "to"), "id", "left").select("__id", F.coalesce("__to", "first").alias("cluster"))
    return keyed.join(cluster, "__id", "left").select(*rows.columns, F.coalesce("cluster", F.col(name)).alias("cluster"))
