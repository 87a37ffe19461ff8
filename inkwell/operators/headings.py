"""Headings: numerals, titles, volumes, and chapters as islands between headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Numerals, units, and the patterns of chapter and volume headings.
DIGITS = {"零": 0, "〇": 0, "O": 0, "o": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000}
NUMERAL = "[0-9零〇一二两三四五六七八九十百千万Oo]+"
VOLUME = rf"^\s*(?:第({NUMERAL})(?:卷|册|部|篇|季|幕)|((?:卷|正文卷|番外卷)[^\n]*))\s*(.*)$"
VOLUME_PREFIX = rf"第{NUMERAL}(?:卷|册|部|篇|季|幕)\s+"
# The class of separators holds the range from "." to "_", so digits and capitals at a title's start go with it.
CHAPTER = rf"^\s*(?:({VOLUME_PREFIX}))?((?:第({NUMERAL})(章|节|回|集|话|部|篇)|序章|楔子|引子|终章|尾声|番外))[\s:：.-_]*(.*)$"
TITLE_NUMBER = "第\\s*([0-9]+|[零〇一二两三四五六七八九十百千万]+)\\s*[章节回節]"


def _value(sign: Column, table: dict[str, int]) -> Column:
    """A sign's value in a table; null if it isn't there."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), sign)


def unit_number(text: Column, bare_wan: bool) -> Column:
    """Numerals with units by place value; ``bare_wan``: a 万 without a digit right before it counts one more.

    The parts between 万 are read each for itself: every unit times the digit next before it, or one, and the digit at the end. All
    parts but the last count ten thousands. Other signs are passed over.
    """
    digits, units = "".join(DIGITS), "".join(UNITS)
    pair = rf"([{digits}]?)[^{digits}{units}]*([{units}])"
    one = lambda value: F.when(value > 0, value).otherwise(1)

    def read(part: Column, wan: bool) -> Column:
        times = lambda digit, unit: (one(_value(digit, DIGITS)) * _value(unit, UNITS)).cast("long")
        products = F.zip_with(F.regexp_extract_all(part, F.lit(pair), F.lit(1)), F.regexp_extract_all(part, F.lit(pair), F.lit(2)), times)
        last = F.coalesce(_value(F.regexp_extract(part, rf"([{digits}])[^{digits}{units}]*$", 1), DIGITS), F.lit(0))
        return F.aggregate(products, (one(last) if wan and bare_wan else last).cast("long"), lambda total, x: total + x)

    parts = F.split(text, "万")
    thousands = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda part: read(part, True))
    return F.aggregate(thousands, read(F.element_at(parts, -1), False), lambda total, x: total + x * 10_000)


def numeral(text: Column) -> Column:
    """PR16, FN23: ASCII digits, numerals read digit by digit, or numerals with units; null if nothing positive is there."""
    plain = "".join(DIGITS)
    read = F.translate(text, plain, "".join(str(v) for v in DIGITS.values()))
    united = unit_number(text, True)
    return (
        F.when(text.rlike("^[0-9]+$"), text.try_cast("long"))
        .when(text.rlike(f"^[{plain}]+$"), read.try_cast("long"))
        .when(united > 0, united)
    )


def title_number(title: Column) -> Column:
    """PR17: the number of a title 第N章, 节, 回 or 節, digits or numerals with units; null without one."""
    found = F.regexp_extract(title, TITLE_NUMBER, 1)
    return F.when(found.rlike("^[0-9]+$"), found.try_cast("long")).when(found != "", unit_number(found, False))


def spaced(title: Column) -> Column:
    """PR19: one space between words and none before colons."""
    one = F.trim(F.regexp_replace(title, r"\s+", " "))
    return F.replace(F.replace(one, F.lit(" :"), F.lit(":")), F.lit(" ："), F.lit("："))


def volume(line: Column) -> Column:
    """PR18: (title, number) of a volume's line; null for other lines."""
    part = lambda k: F.regexp_extract(line, VOLUME, k)
    own = F.trim(part(3))
    title = F.when(own != "", own).when(part(2) != "", part(2)).otherwise(F.trim(line))
    number = F.when(part(1) != "", numeral(part(1)))
    return F.when(line.rlike(VOLUME), F.struct(spaced(title).alias("title"), number.alias("number")))


def chapter(line: Column) -> Column:
    """PR18: (raw, clean, number, marker, volume) of a chapter's heading; null for other lines."""
    part = lambda k: F.regexp_extract(line, CHAPTER, k)
    title, raw = F.trim(part(5)), F.trim(line)
    clean = F.when(part(3) == "", raw).when(title == "", part(2)).otherwise(F.trim(F.concat(F.lit("第"), part(3), part(4), F.lit(" "), title)))
    return F.when(
        line.rlike(CHAPTER),
        F.struct(raw.alias("raw"), clean.alias("clean"), F.when(part(3) != "", numeral(part(3))).alias("number"), part(4).alias("marker"), F.when(part(1) != "", volume(F.trim(part(1)))).alias("volume")),
    )


def chapters(lines: DataFrame, key: str, place: str, line: str) -> DataFrame:
    """Chapters between headings: key, order, title, number, volume, volume_number, lines, content.

    Runs of two or more 节 headings are a list of contents and stay text. A heading right
    behind another with its number or its words is the same heading again; the longer one
    names the chapter. Lines of a volume set what the chapters around them belong to, up
    to the next heading. Text before the first heading is a chapter of its own.
    """
    by_place = Window.partitionBy(key).orderBy("place")
    trimmed = lines.select(key, F.col(place).alias("place"), F.trim(F.col(line)).alias("line")).where("line <> ''")
    parsed = trimmed.withColumn("head", chapter(F.col("line"))).withColumn("vol", volume(F.col("line")))
    # Neighbouring 节 headings have one difference between their ranks among all lines and among their kind.
    weak = F.coalesce(F.col("head.marker") == "节", F.lit(False))
    ranked = parsed.withColumn("weak", weak).withColumn("all_rank", F.row_number().over(by_place))
    run = F.col("all_rank") - F.row_number().over(Window.partitionBy(key, "weak").orderBy("place"))
    in_run = F.count("*").over(Window.partitionBy(key, "weak", "run"))
    kept = ranked.withColumn("run", run).withColumn("head", F.when(~(F.col("weak") & (in_run >= 2)), F.col("head")))
    kind = F.when(F.col("head").isNotNull(), "head").when(F.col("vol").isNotNull(), "volume").otherwise("text")
    event = F.when(kind == "volume", F.col("vol")).otherwise(F.col("head.volume"))
    # The line before, volumes left out.
    seen = F.when(kind != "volume", F.struct(kind.alias("kind"), F.col("head.number").alias("number"), F.regexp_replace("head.raw", r"[\s:：.\-_]+", "").alias("words")))
    before = F.last("seen", True).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    again = (F.col("before.kind") == "head") & (F.coalesce(F.col("before.number") == F.col("seen.number"), F.lit(False)) | (F.col("before.words") == F.col("seen.words")))
    marked = kept.select(key, "place", "line", "head", kind.alias("kind"), event.alias("event"), seen.alias("seen")).withColumn("before", before)
    opens = ((F.col("kind") == "head") & ~F.coalesce(again, F.lit(False))).cast("int")
    placed = marked.withColumn("chapter", F.sum(opens).over(by_place)).withColumn("context", F.last("event", True).over(by_place))
    is_text = F.col("kind") == "text"
    rolled = placed.groupBy(key, "chapter").agg(
        F.max_by(F.when(F.col("kind") == "head", F.col("head.raw")), F.when(F.col("kind") == "head", F.struct(F.length("head.raw").alias("n"), (-F.col("place")).alias("p")))).alias("raw"),
        F.max_by("context", "place").alias("context"),
        F.count_if(is_text).alias("lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(is_text, F.struct("place", "line")))), lambda x: x["line"]), "\n").alias("content"),
    )
    numbered = rolled.where("chapter > 0 OR lines > 0").withColumn("order", F.row_number().over(Window.partitionBy(key).orderBy("chapter")))
    alone = F.count("*").over(Window.partitionBy(key)) == 1
    title = F.coalesce("raw", F.when(alone, "preface").otherwise("chapter_1"))
    return numbered.withColumn("title", title).select(
        key, "order", "title", chapter(F.col("title"))["number"].alias("number"), F.col("context.title").alias("volume"), F.col("context.number").alias("volume_number"), "lines", "content"
    )


def reflowed(text: Column, least: int = 2_000) -> Column:
    """PR5: long lines broken behind sentence ends and closing quotes, if any line is that long.

    Sentence ends are 。, ！, ？ and … before a letter of the script or an opening quote; 」 always ends a line.
    """
    is_long = lambda x: F.length(x) >= least
    broken = lambda x: F.filter(F.transform(F.split(x, "(?<=[。！？…])(?=[一-鿿“「『])|(?<=」)"), F.trim), lambda y: y != "")
    lines = F.split(text, "\r?\n")
    shown = F.flatten(F.transform(lines, lambda x: F.when(F.trim(x) == "", F.array(F.lit(""))).when(is_long(x), broken(x)).otherwise(F.array(x))))
    return F.when(F.exists(lines, lambda x: is_long(x) & (F.trim(x) != "")), F.array_join(shown, "\n")).otherwise(text)


def component(value: Column, fallback: str = "unknown", most: int = 80) -> Column:
    """PR13: a portable file-name part of lower-case letters, digits, hyphens and ideographs."""
    plain = F.regexp_replace(F.lower(F.trim(value)), "[^0-9a-z一-鿿_-]+", "-")
    cut = F.substring(F.regexp_replace(F.regexp_replace(plain, "-+", "-"), "^[-_.]+|[-_.]+$", ""), 1, most)
    return F.when(cut != "", cut).otherwise(fallback)
