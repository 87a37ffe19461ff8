"""Fingerprints of texts and the relations that they show."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.graph import connected_components
from inkwell.session import stored


#: What is stripped from a sentence's ends, the longest sentence that is hashed whole, and the blocks of longer ones.
BORDER = "-_=*~·—…|【】[]()（）《》<>『』「」"
LONG, BLOCK, STEP = 320, 160, 80


def sentence_blocks(text: Column, stops: str = r"[。！？!?；;.\n\r]+") -> Column:
    """GD2: the sentences of a text without white space; a long one as overlapping blocks."""
    plain = F.transform(F.split(text, stops), lambda s: F.btrim(F.regexp_replace(s, r"(?U)\s+", ""), F.lit(BORDER)))
    cut = lambda s: F.transform(F.sequence(F.lit(0), F.length(s) - STEP, F.lit(STEP)), lambda at: F.substring(s, at + 1, F.lit(BLOCK)))
    return F.flatten(F.transform(plain, lambda s: F.when(F.length(s) > LONG, cut(s)).otherwise(F.array(s))))


def anchors(docs: DataFrame, id_col: str, text_col: str, size: int = 96, shortest: int = 18, rejected: str = r"https?://|www\.") -> DataFrame:
    """The bottom-``size`` sketch: id, anchor, position of its first occurrence.

    Blocks of at least ``shortest`` characters are hashed; a hash of neighbours is
    an anchor. A block that is too short or rejected breaks the chain.
    """
    split = docs.select(F.col(id_col).alias("id"), F.posexplode(sentence_blocks(F.col(text_col))).alias("position", "sentence"))
    good = (F.length("sentence") >= shortest) & ~F.col("sentence").rlike(rejected)
    hashed = split.withColumn("h", F.when(good, F.md5("sentence")))
    before = F.lag("h").over(Window.partitionBy("id").orderBy("position"))
    pairs = hashed.withColumn("anchor", F.md5(F.concat(before, F.col("h")))).where("anchor IS NOT NULL")
    first = pairs.groupBy("id", "anchor").agg(F.min("position").alias("position"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("anchor"))
    return first.withColumn("rank", rank).where(F.col("rank") <= size).drop("rank")


def blocked_pairs(rows: DataFrame, key: str, block: int = 64) -> DataFrame:
    """All pairs left < right of ids that share a key, however many do.

    A key with more than about ``block`` rows is dealt out in blocks that meet two at a
    time, so it is spread over many groups of the join. Rows are distinct (key, id).
    """
    held = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key, F.ceil(F.col("n") / block).alias("blocks"))
    own = rows.join(held, key).select(key, "id", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("own"))
    placed = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(key, "id", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    a = placed.where("own = i").select(key, "i", "j", F.col("id").alias("a"))
    b = placed.where("own = j").select(key, "i", "j", F.col("id").alias("b"))
    met = a.join(b, [key, "i", "j"]).where("i < j OR a < b")
    return met.select(key, F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"))


def anchor_candidates(sketch: DataFrame, block: int = 64, least_shared: int = 4) -> DataFrame:
    """Pairs left < right of texts that share enough anchors: left, right, shared.

    Equal sketches meet as one. Pairs are looked for under all but the most frequent
    ``least_shared`` - 1 anchors of each side, in one order for all; those who share enough share
    one of these. What they share is then counted over whole sketches.
    """
    lists = sketch.groupBy("id").agg(F.array_sort(F.collect_list("anchor")).alias("a")).where(F.size("a") >= least_shared)
    lists = stored(lists.withColumn("same", F.sha2(F.to_json(F.struct("a")), 256)), "sketches")
    member = lists.select("id", "same").join(lists.groupBy("same").agg(F.min("id").alias("head"), F.first(F.size("a")).alias("size")), "same").drop("same")
    heads = lists.join(lists.groupBy("same").agg(F.min("id").alias("id")).select("id"), "id", "left_semi").select("id", "a")
    posted = heads.select("id", F.size("a").alias("size"), F.explode("a").alias("anchor"))
    counted = posted.join(posted.groupBy("anchor").agg(F.count("*").alias("n")), "anchor")
    place = F.row_number().over(Window.partitionBy("id").orderBy("n", "anchor"))
    rare = counted.withColumn("place", place).where(F.col("place") <= F.col("size") - (least_shared - 1)).select("anchor", "id")
    met = stored(blocked_pairs(rare, "anchor", block).select("left", "right").distinct(), "met")
    left, right = (heads.select(F.col("id").alias(side), F.col("a").alias(f"{side}_a")) for side in ("left", "right"))
    shared = F.size(F.array_intersect("left_a", "right_a")).cast("long")
    near = met.join(left, "left").join(right, "right").select("left", "right", shared.alias("shared")).where(F.col("shared") >= least_shared)
    of_left, of_right = (member.select(F.col("head").alias(side), F.col("id").alias(f"{side}_id")) for side in ("left", "right"))
    across = near.join(of_left, "left").join(of_right, "right").select(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right"), "shared")
    within = blocked_pairs(member.select("head", "id"), "head", block).join(member.where("id = head").select("head", F.col("size").cast("long").alias("shared")), "head")
    return across.union(within.select("left", "right", "shared"))


def linked_components(sketch: DataFrame, links: Callable[[DataFrame], DataFrame], least_shared: int) -> DataFrame:
    """What links connect, without comparing all that are alike: node, component (the smallest node), of nodes with a link.

    ``links`` is a function of distinct pairs left < right that returns those that link; a pair that links shares ``least_shared`` anchors at least. Texts are
    looked for under all but their ``least_shared`` - 1 most frequent anchors. First each text is compared with the
    smallest id that has the anchor, which joins most copies of a text in as many pairs as there are anchors. Then only
    pairs from different components are made, by component and anchor, and each is compared: none that could still join two
    components is left out.
    """
    counted = sketch.join(sketch.groupBy("anchor").agg(F.count("*").alias("n")), "anchor").withColumn("size", F.count("*").over(Window.partitionBy("id")))
    place = F.row_number().over(Window.partitionBy("id").orderBy("n", "anchor"))
    rare = stored(counted.withColumn("place", place).where(F.col("place") <= F.col("size") - (least_shared - 1)).select("anchor", "id"), "rare-anchors")
    first = rare.groupBy("anchor").agg(F.min("id").alias("left"))
    stars = stored(rare.join(first, "anchor").where("left < id").select("left", F.col("id").alias("right")).distinct(), "stars")
    found = stored(links(stars).select("left", "right"), "star-links")
    parts = stored(connected_components(found, "left", "right"), "star-components")
    placed = rare.join(parts.withColumnRenamed("node", "id"), "id", "left").select("anchor", "id", F.coalesce("component", "id").alias("part"))
    mixed = placed.groupBy("anchor").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("anchor")
    apart = stored(placed.join(mixed, "anchor", "left_semi"), "apart")
    meeting = blocked_pairs(apart.select("anchor", F.col("part").alias("id")).distinct(), "anchor")
    of = lambda side, name: apart.select("anchor", F.col("part").alias(side), F.col("id").alias(name))
    across = meeting.join(of("left", "a"), ["anchor", "left"]).join(of("right", "b"), ["anchor", "right"])
    pairs = across.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right")).distinct().join(stars, ["left", "right"], "left_anti")
    return connected_components(found.union(links(stored(pairs, "across")).select("left", "right")), "left", "right")


def key_pairs(rows: DataFrame, key: str, id_col: str, most: int = 64) -> DataFrame:
    """Pairs left < right of rows that share a key: all pairs where up to ``most`` rows have it, else each row with the first.

    A larger group's rows stay linked through its smallest id, in as many pairs as it has rows.
    """
    counted = rows.groupBy(key).agg(F.count("*").alias("n"), F.min(id_col).alias("first")).where("n > 1")
    known = rows.join(counted, key).select(key, id_col, "n", "first")
    few = known.where(F.col("n") <= most)
    left, right = (few.select(key, F.col(id_col).alias(side)) for side in ("left", "right"))
    pairs = left.join(right, key).where(F.col("left") < F.col("right"))
    many = known.where((F.col("n") > most) & (F.col(id_col) > F.col("first"))).select(key, F.col("first").alias("left"), F.col(id_col).alias("right"))
    return pairs.union(many)


def compared(left: Column, right: Column) -> Column:
    """Similarity of two sorted bottom sketches below the smaller of their largest values: jaccard, containment, shared."""
    limit = F.least(F.array_max(left), F.array_max(right))
    a, b = (F.filter(x, lambda v: v <= limit) for x in (left, right))
    shared = F.size(F.array_intersect(a, b))
    return F.struct(
        (shared / F.size(F.array_union(a, b))).alias("jaccard"), (shared / F.least(F.size(a), F.size(b))).alias("containment"), shared.cast("long").alias("shared")
    )


@dataclass(frozen=True)
class Thresholds:
    """When a pair is an edition, a truncated copy, a version or a likely relative. Fixed values."""

    least_chars: int = 50_000
    edition: tuple[float, float, float, float, int] = (0.97, 0.96, 0.90, 0.98, 10)
    incomplete: tuple[float, float, float, float, int] = (0.45, 0.80, 0.99, 0.99, 24)
    version: tuple[float, float, float, int] = (0.70, 0.92, 0.95, 10)
    relative: tuple[float, float, int] = (0.65, 0.85, 5)
    collision: float = 0.30


#: Names that say nothing about who wrote a text. Fixed values.
UNKNOWN_AUTHORS = ("佚名", "未知", "未知作者", "unknown", "anonymous")


def consistent(similarity: Column) -> Column:
    """FI8: whether titles and authors of a pair allow that one text is a truncated copy of the other.

    Equal titles tolerate a missing author but no conflict; else a known author and a very similar title are needed.
    """
    name = lambda side: F.trim(F.coalesce(F.col(f"{side}_author"), F.lit("")))
    title = lambda side: F.coalesce(F.col(f"{side}_title"), F.lit(""))
    left, right = name("left"), name("right")
    both = (left != "") & (right != "")
    same_title = (title("left") != "") & (title("left") == title("right"))
    known = both & (left == right) & ~F.lower(left).isin(*UNKNOWN_AUTHORS)
    return (same_title & ~(both & (left != right))) | (known & (similarity >= 0.92))


def relation(t: Thresholds = Thresholds()) -> Column:
    """GD4: the relation of a pair of different texts.

    It has columns left_chars, right_chars, length_ratio, jaccard, containment, order, shared, same_title, consistent.
    """
    ratio, cover, jaccard, order, shared = (F.col(c) for c in ("length_ratio", "containment", "jaccard", "order", "shared"))
    large = F.least("left_chars", "right_chars") >= t.least_chars
    edition = (ratio >= t.edition[0]) & (cover >= t.edition[1]) & (jaccard >= t.edition[2]) & (order >= t.edition[3]) & (shared >= t.edition[4])
    shorter = F.col("consistent") & (F.col("left_chars") != F.col("right_chars"))
    incomplete = ratio.between(*t.incomplete[:2]) & (cover >= t.incomplete[2]) & (order >= t.incomplete[3]) & (shared >= t.incomplete[4]) & shorter
    version = (ratio >= t.version[0]) & (cover >= t.version[1]) & (order >= t.version[2]) & (shared >= t.version[3])
    relative = (cover >= t.relative[0]) & (order >= t.relative[1]) & (shared >= t.relative[2])
    return (
        F.when(large & edition, "same_edition")
        .when(large & incomplete, "possible_incomplete")
        .when(large & version, "same_work_version")
        .when(large & relative, "possible_same_work")
        .when(F.col("same_title") & (cover < t.collision), "title_collision")
        .otherwise("distinct")
    )


#: Anchors that automatic relations of different texts share at least.
LEAST_AUTOMATIC = min(Thresholds.edition[4], Thresholds.incomplete[4], Thresholds.version[3])
#: Relations that put two texts in one work without review.
AUTOMATIC = ("byte_exact", "text_exact", "same_edition", "possible_incomplete", "same_work_version")


def edges_of(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Undirected edges once each, smaller end first, without loops."""
    return pairs.select(F.least(left, right).alias("left"), F.greatest(left, right).alias("right")).where(F.col("left") != F.col("right")).distinct()


def best_row(rows: DataFrame, group: str, *order: Column) -> DataFrame:
    """The first row of each group in an order."""
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where("__rank = 1").drop("__rank")
