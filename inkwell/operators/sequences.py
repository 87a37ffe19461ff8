"""Ordered rows within a key: windows, sessions, boundaries, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordinals(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Adds index (from 0) and total within a key."""
    by_order = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("index", F.row_number().over(by_order) - 1).withColumn("total", F.count("*").over(Window.partitionBy(key)))


def window_starts(index: Column, total: Column, size: int, step: int, least: int, pull_back: bool) -> Column:
    """The windows (start, window) that a row of this index falls into, by arithmetic: size / step + 1 at most.

    Windows begin at multiples of the step. With ``pull_back`` a tail shorter than
    ``size`` begins at total - size, and keys with at most ``size`` or ``least`` rows have
    one window; without it a window opens at each step until one reaches the end.
    """
    one = total <= (max(size, least) if pull_back else size)
    last = F.when(one, 0).otherwise(total - size if pull_back else F.ceil((total - size) / step) * step).cast("int")
    low = F.greatest(F.lit(0), F.ceil((index - size + 1) / step)).cast("int")
    high = F.floor(F.least(index, last) / step).cast("int")
    place = lambda start, window: F.struct(start.cast("int").alias("start"), window.cast("int").alias("window"))
    regular = F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), lambda k: place(k * step, k + 1))).otherwise(F.array().cast("array<struct<start:int,window:int>>"))
    if not pull_back:
        return regular
    tail = (last % step != 0) & (index >= last) & (index < last + size)
    return F.when(tail, F.array_append(regular, place(last, F.floor(last / step) + 2))).otherwise(regular)


def sliding_windows(rows: DataFrame, key: str, order: str, size: int = 20, overlap: int = 10, least: int = 8, pull_back: bool = True) -> DataFrame:
    """One row per window: key, window, start, first and last order, rows, orders.

    Rows find their windows by arithmetic on their index, so nothing is joined.
    """
    placed = ordinals(rows, key, order)
    mine = window_starts(F.col("index").cast("int"), F.col("total").cast("int"), size, size - overlap, least, pull_back)
    shared = placed.select(key, order, F.explode(mine).alias("w")).select(key, order, "w.start", "w.window")
    return shared.groupBy(key, "start", "window").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("rows"), F.array_sort(F.collect_list(order)).alias("orders"))


def tiled(windows: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """Segments repaired so that they tile their windows: keys, first, last, gap.

    ``windows``: keys, orders (sorted); ``segments``: keys, first, last. Segments shrink to
    the orders that they hold. By start and end, one begins behind the largest end before it,
    and is dropped where nothing is left; what no segment holds is a gap. A window without
    segments is one gap.
    """
    within = lambda test: F.size(F.filter("orders", test))
    low, high = within(lambda x: x < F.col("from")), within(lambda x: x <= F.col("to")) - 1
    named = segments.select(*keys, F.col("first").alias("from"), F.col("last").alias("to"))
    held = windows.join(named, keys).withColumn("low", low).withColumn("high", high).where("low <= high")
    in_order = Window.partitionBy(*keys).orderBy("low", "high")
    before = F.coalesce(F.max("high").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    own = held.select(*keys, "orders", "low", "high", before.alias("before")).where("high > before")
    # A mark at the end of each window closes it with a gap, if orders are left.
    closing = windows.select(*keys, "orders", F.size("orders").alias("low"), F.size("orders").alias("high"))
    done = own.groupBy(*keys).agg(F.max("high").alias("before"))
    ends = closing.join(done, keys, "left").select(*keys, "orders", "low", "high", F.coalesce("before", F.lit(-1)).alias("before"))
    at = lambda place: F.get("orders", place)
    gaps = own.union(ends).where("low > before + 1").select(*keys, at(F.col("before") + 1).alias("first"), at(F.col("low") - 1).alias("last"), F.lit(True).alias("gap"))
    kept = own.select(*keys, at(F.greatest("low", F.col("before") + 1)).alias("first"), at(F.col("high")).alias("last"), F.lit(False).alias("gap"))
    return kept.union(gaps)


def sessions(rows: DataFrame, key: str, order: str, opens: Column) -> DataFrame:
    """Adds session, counted from 1 at each row that opens one; rows before the first have 0. A run of openers right after each other opens one session."""
    by_order = Window.partitionBy(key).orderBy(order)
    flagged = rows.withColumn("__opens", opens)
    fresh = F.col("__opens") & ~F.coalesce(F.lag("__opens").over(by_order), F.lit(False))
    return flagged.withColumn("__fresh", fresh.cast("int")).withColumn("session", F.sum("__fresh").over(by_order)).drop("__opens", "__fresh")


def anomalies(chapters: DataFrame, key: str, order: str, chars: str, paragraphs: str) -> DataFrame:
    """Chapters with reasons: gaps in order, empty or odd lengths, one long paragraph."""
    by_order, whole = Window.partitionBy(key).orderBy(order), Window.partitionBy(key)
    expected = F.coalesce(F.lag(order).over(by_order) + 1, F.lit(1))
    mean = F.avg(F.when(F.col(chars) > 0, F.col(chars))).over(whole)
    n = F.col(chars)
    placed = chapters.withColumn("__expected", expected).withColumn("__mean", mean)
    length = (
        F.when(n == 0, "empty_content").when(n < 80, "very_short_content").when(n < F.col("__mean") * 0.12, "short_length_outlier").when(n > F.col("__mean") * 4, "long_length_outlier")
    )
    reasons = F.array_compact(
        F.array(
            F.when(F.col(order) != F.col("__expected"), F.concat(F.lit("non_contiguous_order_expected_"), F.col("__expected").cast("string"))),
            length,
            F.when((F.col(paragraphs) <= 1) & (n > 300), "single_paragraph_long_chapter"),
        )
    )
    return placed.withColumn("reasons", reasons).where(F.size("reasons") > 0).drop("__expected", "__mean")


def boundary_votes(segments: DataFrame, candidates: DataFrame, uncertain: DataFrame, windows: DataFrame, key: str) -> DataFrame:
    """Votes for each boundary, the place after an order, from overlapping windows.

    ``windows``: key, orders; ``segments``: key, end, uncertain_after, next_uncertain_before,
    level, last_end of its window; ``candidates``: key, boundary, strength, split;
    ``uncertain``: key, boundary.
    """
    chances = windows.select(key, F.explode(F.slice("orders", F.lit(1), F.size("orders") - 1)).alias("boundary")).groupBy(key, "boundary").agg(F.count("*").alias("opportunities"))
    weight = F.when(F.col("uncertain_after"), 0.5).otherwise(0.75) * F.when(F.col("level").isin("setup", "transition"), 0.65).otherwise(1.0) * F.when(F.col("next_uncertain_before"), 0.5).otherwise(1.0)
    none = F.lit(0).cast("long")
    ends = segments.where("end < last_end").select(key, F.col("end").alias("boundary"), weight.alias("votes"), none.alias("hard"), none.alias("strong"), none.alias("forbid"))
    strength = F.col("strength")
    points = F.when(~F.col("split"), 0.0).when(strength == "hard", 1.5).when(strength == "strong", 1.0).when(strength == "weak", 0.5).otherwise(0.0)
    is_a = lambda name: (strength == name).cast("long").alias(name)
    named = candidates.select(key, "boundary", points.alias("votes"), is_a("hard"), is_a("strong"), is_a("forbid"))
    unsure = uncertain.select(key, "boundary", F.lit(0.25).alias("votes"), none.alias("hard"), none.alias("strong"), none.alias("forbid"))
    sums = ends.union(named).union(unsure).groupBy(key, "boundary").agg(*[F.sum(c).alias(c) for c in ("votes", "hard", "strong", "forbid")])
    return sums.join(chances, [key, "boundary"]).withColumn("support", F.col("votes") / F.col("opportunities"))


def selected() -> Column:
    """Whether the columns votes, support, hard, strong and forbid make a boundary."""
    blocked = F.col("forbid") > F.greatest("hard", "strong")
    clear = (F.col("hard") > 0) & (F.col("forbid") == 0)
    return ~blocked & (clear | ((F.col("votes") >= 2) & (F.col("support") >= 0.55)) | ((F.col("support") >= 0.8) & (F.col("votes") >= 1)))


def cut(rows: DataFrame, boundaries: DataFrame, key: str, order: str) -> DataFrame:
    """Adds plot, counted from 1: a new one begins after each boundary."""
    marked = rows.join(boundaries.select(key, F.col("boundary").alias(order), F.lit(1).alias("__cut")), [key, order], "left")
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return marked.withColumn("plot", F.coalesce(F.sum("__cut").over(before), F.lit(0)) + 1).drop("__cut")


def boundary_quality(left: Column, right: Column, chapters: Column, most: int = 24) -> Column:
    """0 to 1 from the support of both edges and the number of chapters."""
    known = F.array_compact(F.array(left, right))
    mean = F.when(F.size(known) == 0, 0.35).otherwise(F.aggregate(known, F.lit(0.0), lambda t, x: t + x) / F.size(known))
    length = F.when(chapters == 1, -0.1).otherwise(0.0) + F.when(chapters > most, -0.22).otherwise(0.0) + F.when(chapters >= 24, -0.16).when(chapters >= 16, -0.08).otherwise(0.0)
    strong = F.size(F.filter(known, lambda x: x >= 0.75))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean + length + F.when(strong == 2, 0.1).when((strong == 1) & (F.size(known) == 1), 0.04).otherwise(0.0)))


def overlaps(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """For each left range and right window, the right range with the best Jaccard of orders.

    ``left``: key, plot, orders; ``right``: key, window, segment, orders. Orders meet in
    an equi-join, so ranges that share none are never paired.
    """
    a = left.select(key, "plot", F.size("orders").alias("na"), F.explode("orders").alias("order"))
    b = right.select(key, "window", "segment", F.size("orders").alias("nb"), F.explode("orders").alias("order"))
    both = a.join(b, [key, "order"]).groupBy(key, "plot", "window", "segment", "na", "nb").agg(F.count("*").alias("n"))
    scored = both.withColumn("jaccard", F.col("n") / (F.col("na") + F.col("nb") - F.col("n")))
    best = Window.partitionBy(key, "plot", "window").orderBy(F.desc("jaccard"), F.asc("segment"))
    return scored.withColumn("rank", F.row_number().over(best)).where("rank = 1").select(key, "plot", "window", "segment", "jaccard")


def shape(chapters: DataFrame, key: str, chars: str) -> DataFrame:
    """By book: chapters, mean, nearest-rank ninth decile, most, and whether the book has long chapters."""
    n, mean, ninth = F.count("*"), F.avg(chars), F.percentile_disc(chars, 0.9) if hasattr(F, "percentile_disc") else F.expr(f"percentile_disc(0.9) WITHIN GROUP (ORDER BY {chars})")
    rolled = chapters.groupBy(key).agg(n.alias("chapters"), mean.alias("mean_chars"), ninth.cast("long").alias("p90_chars"), F.max(chars).alias("most_chars"), F.sum(chars).alias("total_chars"))
    long = (F.col("mean_chars") > 8_000) | (F.col("p90_chars") > 12_000) | ((F.col("chapters") < 300) & (F.col("total_chars") >= 1_500_000))
    return rolled.withColumn("shape", F.when(long, "long").otherwise("regular"))


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest row of each key by an order, as an aggregate that combines before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return newest.select(key, *[F.col("r")[c].alias(c) for c in rest])


def versions(rows: DataFrame, known: DataFrame, work: str, edition: str) -> DataFrame:
    """Version numbers: known ones stay, others follow the largest, by edition."""
    joined = rows.select(work, edition).distinct().join(known.select(work, edition, "version"), [work, edition], "left")
    largest = F.coalesce(F.max("version").over(Window.partitionBy(work)), F.lit(0))
    turn = F.row_number().over(Window.partitionBy(work, F.col("version").isNull()).orderBy(edition))
    return joined.withColumn("__largest", largest).withColumn("__turn", turn).select(work, edition, F.coalesce("version", F.col("__largest") + F.col("__turn")).alias("version"))


def phase(index: Column, total: Column) -> Column:
    """One of five phases by place: up to 10, 35, 60, 82 and 100 per cent."""
    ratio = (index + 1) / total
    return F.when(ratio <= 0.1, "opening").when(ratio <= 0.35, "rise").when(ratio <= 0.6, "middle").when(ratio <= 0.82, "turn").otherwise("ending")


def forced_cuts(scores: Column, most: int = 24) -> Column:
    """Where a segment that has no boundary of its own is cut, as places in it: a cut follows each.

    ``scores`` has a number for each place of the segment. While more than ``most`` places are left, the next cut is the best of those up to four
    places around the ``most``-th of them, less 0.03 for each place away from it, the first of equals; no piece is
    shorter than half of ``most``, and a last place never stands alone.
    """
    n = F.size(scores)
    least = max(5, most // 2) - 1

    def step(state: Column, _: Column) -> Column:
        start = state["start"]
        last = n - 2
        target = F.least(last, start + most - 1)
        low = F.greatest(start + 2, target - 4, F.least(last, start + least))
        low, high = F.least(low, target), F.least(last, target + 4)
        ranked = F.transform(F.sequence(low, F.greatest(low, high)), lambda at: F.struct((0.03 * F.abs(at - target) - F.get(scores, at)).alias("cost"), at.alias("at")))
        best = F.array_min(F.transform(ranked, lambda x: F.struct(F.round(x["cost"], 6).alias("cost"), x["at"].alias("at"))))["at"]
        more = F.struct((best + 1).cast("int").alias("start"), F.array_append(state["cuts"], best.cast("int")).alias("cuts"))
        return F.when(n - start > most, more).otherwise(state)

    begin = F.struct(F.lit(0).cast("int").alias("start"), F.array().cast("array<int>").alias("cuts"))
    turns = F.sequence(F.lit(0), F.floor(n / (least + 1)).cast("int"))
    return F.aggregate(turns, begin, step)["cuts"]


def refined(rows: DataFrame, segments: DataFrame, key: str, order: str, analyse, assess: DataFrame, most: int = 24, rounds: int = 2, size: int = 32, overlap: int = 12, least: int = 10) -> DataFrame:
    """Rows with the first order of their segment after long segments are cut again: key, order, first.

    ``segments``: key, order, first, the segments so far. ``analyse`` is a function of windows (key, window, orders) that gives the
    frames segments, candidates and uncertain of ``boundary_votes``, whose key is the windows'. ``assess``: key, boundary,
    confidence, split, where a boundary is the order before it.

    A segment of over ``most`` rows is windowed, voted on and cut where ``selected`` says so. If nothing is selected, or after ``rounds``
    rounds, it is cut by force, where confidence + support + 1.2 hard + 0.5 strong - 0.9 forbid, and 1 for a split, is best. This goes on until
    no segment is longer than ``most``. Orders are unique in a key, and one key's rows fit a task, as
    in all windows here. Boundaries without votes or assessment count 0. An empty table gives an empty result.
    """
    from inkwell.session import drop_stored, stored

    now, depth = stored(segments.select(key, order, "first").join(rows.select(key, order), [key, order], "left_semi"), "segments"), 0
    done = now.limit(0)
    while True:
        depth += 1
        counted = now.groupBy(key, "first").agg(F.count("*").alias("n"))
        done = done.unionByName(now.join(counted.where(F.col("n") <= most).select(key, "first"), [key, "first"], "left_semi"))
        long = stored(now.join(counted.where(F.col("n") > most).select(key, "first"), [key, "first"], "left_semi"), "long-segments")
        if long.isEmpty():
            return done
        named = long.select(F.struct(key, "first").alias("segment"), F.col(order))
        windows = sliding_windows(named, "segment", order, size, overlap, least).select("segment", "window", "orders", "last")
        votes = stored(boundary_votes(*analyse(windows), windows, "segment"), "votes")
        chosen = votes.where(selected()).select("segment", F.col("boundary").alias(order)) if depth <= rounds else votes.limit(0).select("segment", F.col("boundary").alias(order))
        score = F.coalesce("confidence", F.lit(0.0)) + F.when(F.col("split"), 1.0).otherwise(0.0) + F.coalesce("support", F.lit(0.0))
        score = score + 1.2 * F.coalesce("hard", F.lit(0)) + 0.5 * F.coalesce("strong", F.lit(0)) - 0.9 * F.coalesce("forbid", F.lit(0))
        single = named.join(chosen.select("segment").distinct(), "segment", "left_anti")
        facts = assess.select(F.col(key).alias("__key"), F.col("boundary").alias("__at"), "confidence", "split")
        known = single.join(facts, (F.col(f"segment.{key}") == F.col("__key")) & (F.col(order) == F.col("__at")), "left").join(votes.withColumnRenamed("boundary", order), ["segment", order], "left")
        listed = known.groupBy("segment").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("order"), score.alias("score")))).alias("s"))
        cuts = forced_cuts(F.transform("s", lambda x: x["score"]), most)
        forced = listed.select("segment", F.explode(F.transform(cuts, lambda at: F.get("s", at)["order"])).alias(order))
        marked = named.join(chosen.union(forced).withColumn("__cut", F.lit(True)), ["segment", order], "left")
        in_order = Window.partitionBy("segment").orderBy(order)
        opens = F.when(F.lag("__cut").over(in_order) | F.lag(order).over(in_order).isNull(), F.col(order))
        first = F.last(opens, ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        now = stored(marked.select(F.col(f"segment.{key}").alias(key), order, first.alias("first")), "segments")
        for old in (long, votes):
            drop_stored(old)
