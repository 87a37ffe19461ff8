"""Names, genres, rankings and tolerant JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import squeezed

#: What a directory segment that names a genre adds, and what a keyword's strength is multiplied with. Fixed values.
SEGMENT, PLACES = 6.5, {"title": 1.7, "path": 1.25, "excerpt": 0.34}
#: The genre of texts that no keyword places. Fixed value.
OTHER = "其他"


def book_name(raw: Column) -> Column:
    """Title, author and confidence from a file name.

    Book marks make a sure title; a labelled author is sure, one behind a spaced label
    nearly so; a bare separator leaves both open. Names without a title keep their stem.
    """
    # The patterns of marks, labels and separators.
    stem = F.regexp_replace(F.regexp_extract(raw, r"([^/\\]*)$", 1), r"(?i)\.(?:txt|epub|md)$", "")
    marked = F.regexp_extract(stem, "《\\s*([^《》]{1,240}?)\\s*》", 1)
    label = "(?:作者|著者|作家)\\s*[:：]\\s*(.+?)\\s*$"
    spaced = "^(.+?)\\s+(?:作者|著者|作家|文)\\s+(\\S.{0,59})\\s*$"
    parted = "^(.+?)\\s*(?:\\s+by\\s+|[-—–_])\\s*([^《》:：/\\\\,，。!?！？;；-]{1,30})$"
    labelled = F.regexp_extract(stem, label, 1)
    by_space = F.regexp_extract(stem, spaced, 2)
    bare = F.when((marked == "") & (labelled == "") & (by_space == ""), F.regexp_extract(stem, parted, 2)).otherwise("")
    author = F.when(labelled != "", labelled).when(by_space != "", by_space).when(bare != "", bare)
    author_sure = F.when(labelled != "", 0.99).when(by_space != "", 0.94).when(bare != "", 0.58).otherwise(0.0)
    rest = F.when(labelled != "", F.regexp_replace(stem, label, "")).when(by_space != "", F.regexp_extract(stem, spaced, 1)).when(bare != "", F.regexp_extract(stem, parted, 1)).otherwise(stem)
    title = F.when(marked != "", marked).otherwise(squeezed(F.regexp_replace(rest, r"^[ ._—–-]+|[ ._—–-]+$", "")))
    sure = F.when(marked != "", 0.99).when(bare != "", 0.62).when(author.isNotNull(), 0.91).otherwise(0.78)
    overall = F.when(author.isNotNull(), sure * 0.82 + author_sure * 0.18).otherwise(sure - 0.04)
    return F.struct(F.when(title == "", stem).otherwise(title).alias("title"), squeezed(author).alias("author"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(0.999), overall)), 4).alias("confidence"))


def genre_scores(rows: DataFrame, key: str, rules: list[tuple[str, str, float]], fields: dict[str, Column], segment: Column | None = None) -> DataFrame:
    """Scores by genre: each keyword found in a field adds its strength times the field's weight; a directory segment adds its own."""
    hits = [F.struct(F.lit(genre).alias("genre"), (F.lit(strength * PLACES[place]) * F.contains(text, F.lit(word)).cast("double")).alias("points")) for genre, word, strength in rules for place, text in fields.items()]
    if segment is not None:
        hits += [F.struct(F.lit(genre).alias("genre"), F.when(segment == genre, SEGMENT).otherwise(0.0).alias("points")) for genre in dict.fromkeys(g for g, _, _ in rules)]
    return rows.select(key, F.explode(F.array(*hits)).alias("h")).groupBy(key, "h.genre").agg(F.sum("h.points").alias("score")).where("score > 0")


def classified_genres(rows: DataFrame, key: str, scores: DataFrame, order: list[str], least: float = 0.9) -> DataFrame:
    """The best genre of each row with a confidence from its score and its lead; ties go by ``order``."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("genre"))
    ranked = scores.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), place)))
    best = ranked.where("rank = 1").select(key, "genre", F.col("score").alias("top"))
    second = ranked.where("rank = 2").select(key, F.col("score").alias("next"))
    joined = rows.select(key).join(best, key, "left").join(second, key, "left").withColumn("lead", F.col("top") - F.coalesce("next", F.lit(0.0)))
    sure = F.coalesce(F.col("top") >= least, F.lit(False))
    confidence = 0.40 + F.least(F.lit(0.40), 0.07 * F.col("top")) + F.least(F.lit(0.14), 0.035 * F.col("lead")) - F.when(F.col("lead") < 0.8, 0.12).otherwise(0.0)
    return joined.select(key, F.when(sure, F.col("genre")).otherwise(OTHER).alias("genre"), F.when(sure, F.greatest(F.lit(0.2), F.least(F.lit(0.98), confidence))).otherwise(0.2).alias("confidence"))


def ranked_candidates(rows: DataFrame, item: str, key: str, source: str, confidence: str, agree: tuple[str, str], bonus: float = 0.12) -> DataFrame:
    """The best key of each item: the most of each source, summed, with a bonus where two sources agree.

    Scores equal to nine places tie, as sums depend on the order of what they add; ties go to the smaller key.
    """
    best = rows.groupBy(item, key, source).agg(F.max(confidence).alias("c"))
    summed = best.groupBy(item, key).agg(F.sum("c").alias("score"), F.bool_or(F.col(source) == agree[0]).alias("a"), F.bool_or(F.col(source) == agree[1]).alias("b"))
    scored = summed.select(item, key, (F.col("score") + F.when(F.col("a") & F.col("b"), bonus).otherwise(0.0)).alias("score"))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(item).orderBy(F.desc(F.round("score", 9)), key))).where("rank = 1").drop("rank")


def ordered_by_number(rows: DataFrame, key: str, order: str, number: str, share: float = 0.6, least: int = 3) -> DataFrame:
    """Adds place: by number where at least ``share`` of a key's rows, and ``least``, have one; else by order."""
    whole = Window.partitionBy(key)
    enough = F.count(number).over(whole) >= F.greatest(F.lit(float(least)), share * F.count("*").over(whole))
    marked = rows.withColumn("__by", F.when(enough, F.coalesce(F.col(number), F.lit(1 << 60))).otherwise(F.lit(0)))
    return marked.withColumn("place", F.row_number().over(whole.orderBy("__by", order))).drop("__by")


def balanced_objects(text: Column) -> Column:
    """FN4: the complete outermost {...} of a text, in order, with braces in strings left alone.

    The text is read in pieces: a brace or quote, a backslash with the sign after it, or what lies between. Strings count inside of
    objects only. An object that never ends gives nothing, nor does what it holds.
    """
    pieces = F.regexp_extract_all(text, F.lit(r"(\\(?s:.)|[\"{}]|[^\\\"{}]+|\\)"))
    begin = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(0).alias("at"), F.lit(0).alias("start"), F.array().cast("array<struct<start:int,size:int>>").alias("found"))

    def step(state: Column, piece: Column) -> Column:
        opens, closes = (piece == "{") & ~state["quoted"], (piece == "}") & ~state["quoted"] & (state["depth"] > 0)
        after = state["at"] + F.length(piece)
        whole = F.struct(state["start"].alias("start"), (after - state["start"]).alias("size"))
        return F.struct(
            (state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"), F.when((piece == '"') & (state["depth"] > 0), ~state["quoted"]).otherwise(state["quoted"]).alias("quoted"),
            after.alias("at"), F.when(opens & (state["depth"] == 0), state["at"]).otherwise(state["start"]).alias("start"),
            F.when(closes & (state["depth"] == 1), F.array_append(state["found"], whole)).otherwise(state["found"]).alias("found"),
        )

    return F.transform(F.aggregate(pieces, begin, step)["found"], lambda x: F.substring(text, x["start"] + 1, x["size"]))


def json_object(answer: Column) -> Column:
    """FN4: the first JSON object of a model's answer, without fences and text around it; null if there is none."""
    bare = F.regexp_replace(answer, r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", "")
    return F.get(F.filter(balanced_objects(bare), lambda x: F.try_parse_json(x).isNotNull()), F.lit(0))


def strict_json(answer: Column) -> Column:
    """FN4: an answer that is one JSON object but for white space around it; null if it has fences or other text."""
    bare = F.regexp_replace(answer, r"^\s+|\s+$", "")
    return F.when((F.get(balanced_objects(bare), F.lit(0)) == bare) & F.try_parse_json(bare).isNotNull(), bare)


def stale_tokens(rows: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """How often texts name what a pattern matches, and the first name."""
    return rows.select(key, F.regexp_count(text, F.lit(pattern)).cast("long").alias("n"), F.regexp_extract(text, pattern, 0).alias("first")).where("n > 0")


def group_allowed(members: Column) -> Column:
    """Whether member source lists hold two books at least and none twice."""
    flat = F.flatten(members)
    return (F.size(F.array_distinct(flat)) >= 2) & (F.size(F.array_distinct(flat)) == F.size(flat))


def synopsis(primary: Column, fallback: Column, parts: Column, limit: int = 3) -> Column:
    """The first text that is there, else the first parts joined."""
    joined = F.array_join(F.slice(parts, 1, limit), "；")
    return F.when(F.coalesce(primary, F.lit("")) != "", primary).when(F.coalesce(fallback, F.lit("")) != "", fallback).otherwise(joined)


def outcome(state: Column) -> Column:
    """What a transfer state means."""
    return (
        F.when(state.isin("F", "moved"), F.struct(F.lit("published").alias("label"), F.lit(True).alias("source_deleted")))
        .when(state.isin("P", "copied"), F.struct(F.lit("published").alias("label"), F.lit(False).alias("source_deleted")))
        .otherwise(F.struct(F.lit("pending").alias("label"), F.lit(False).alias("source_deleted")))
    )
