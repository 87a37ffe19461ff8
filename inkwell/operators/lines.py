"""Lines of texts: frequency, place, noise tiers and summaries.

Rules come as a pack, so the same operators serve any script. ``lines`` frames have
book, position, line (raw) and normal (its normal form).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import normal_line, stripped


@dataclass(frozen=True)
class NoisePack:
    """Patterns and words that mark noise or protect prose. All patterns suit Java and RE2.

    ``literals`` gives for a pattern literals of which all its matches contain one at least, so that lines without them needn't be searched.
    """

    heading: str
    strong: tuple[str, ...] = ()
    strong_words: tuple[str, ...] = ()
    weak: tuple[str, ...] = ()
    weak_words: tuple[str, ...] = ()
    soft_meta: str = "$^"
    boilerplate: str = "$^"
    prose: tuple[tuple[str, int], ...] = ()
    script: str = "[A-Za-z]"
    most_prose: int = field(default=6)
    literals: dict[str, tuple[str, ...]] = field(default_factory=dict, hash=False)


# Fixed value: a whole line of letters, digits and address signs.
CODE_LINE = r"^[A-Za-z0-9_.:/?&=%#@+\-]{8,}$"


def _word(words: str) -> str:
    """A pattern of whole words; the engines' own word boundaries differ beyond ASCII."""
    return rf"(?:^|[^\p{{L}}])(?:{words})(?:[^\p{{L}}]|$)"


#: Rules for Latin scripts.
LATIN = NoisePack(
    heading=r"^(?:[Cc]hapter|[Kk]apitel|[Cc]hapitre)\s+[0-9IVXLC]+",
    strong=(r"^https?://", r"(?:^|[^\p{L}])www\.", r"^(?:next|previous) (?:page|chapter)$", r"(?:all rights reserved|click here|subscribe now)", r"(?:\S+\*\*\*|\S+%%%)\s"),
    strong_words=("!!", "cookie policy", "@@"),
    weak=(r"(?:licensed|released) under", r"\|", r"^[A-Z\s!,.]{20,}$", r"^-{4,}$"),
    weak_words=("$$$", "###", "&&&", "vote", "follow"),
    soft_meta=r"(?:please|thanks).{0,16}(?:support|vote|share)",
    boilerplate=r"(?:[Cc]ookies|accept all|reject all|privacy settings)",
    prose=((r"[\"“”]", 2), (_word("he|she|they|er|sie|il|elle"), 2), (_word("thought|felt|saw|heard"), 1), (_word("door|window|street|rain|wind"), 1), (r"^[A-ZÀ-Ý].{40,}[.!?]$", 1)),
    literals={
        r"(?:^|[^\p{L}])www\.": ("www.",), r"(?:all rights reserved|click here|subscribe now)": ("all rights reserved", "click here", "subscribe now"),
        r"(?:\S+\*\*\*|\S+%%%)\s": ("***", "%%%"), r"(?:licensed|released) under": ("licensed under", "released under"), r"\|": ("|",),
        r"(?:please|thanks).{0,16}(?:support|vote|share)": ("please", "thanks"), r"(?:[Cc]ookies|accept all|reject all|privacy settings)": ("ookies", "accept all", "reject all", "privacy settings"),
        r"[\"“”]": ('"', "“", "”"), _word("thought|felt|saw|heard"): ("thought", "felt", "saw", "heard"), _word("door|window|street|rain|wind"): ("door", "wind", "street", "rain"),
    },
)


def has(line: Column, pattern: str, pack: NoisePack) -> Column:
    """Whether a pattern is found in a line, which is searched only if it holds what all matches hold."""
    literals = [line.contains(word) for word in pack.literals.get(pattern, ())]
    return reduce(or_, literals) & line.rlike(pattern) if literals else line.rlike(pattern)


def lines_of(docs: DataFrame, book: str, text: str, *others: str) -> DataFrame:
    """One row per line that isn't blank: book, position in the text, line, normal, and other columns of its document."""
    split = docs.select(F.col(book).alias("book"), *others, F.posexplode(F.split(text, "\n")).alias("position", "line"))
    return split.where(F.col("line").rlike(r"(?U)\S")).withColumn("normal", normal_line(F.col("line")))


def frequency_key(normal: Column) -> Column:
    """What lines are counted by: lower case, digits made alike; null for short lines."""
    key = F.regexp_replace(F.lower(normal), "[0-9]+", "#")
    return F.when(F.length(key) >= 6, key)


def frequencies(lines: DataFrame, pack: NoisePack) -> DataFrame:
    """How often each key occurs in each book, headings left out."""
    keyed = lines.where(~F.col("normal").rlike(pack.heading)).withColumn("key", frequency_key(F.col("normal")))
    return keyed.where("key IS NOT NULL").groupBy("book", "key").agg(F.count("*").alias("n"))


def with_frequency(lines: DataFrame, pack: NoisePack) -> DataFrame:
    """Adds frequency: how often a line's key occurs in its book as in ``frequencies``, null where it has none.

    Lines that lie together by book are counted where they are; keys are sorted by their hashes first, as they are as long as lines.
    """
    normal = F.col("normal")
    counted = lines.withColumn("__key", frequency_key(normal)).withColumn("__hash", F.xxhash64("__key")).withColumn("__counts", ~normal.rlike(pack.heading))
    found = F.count_if(F.col("__counts")).over(Window.partitionBy("book", "__hash", "__key"))
    return counted.withColumn("frequency", F.when(F.col("book").isNotNull() & F.col("__key").isNotNull() & (found > 0), found)).drop("__key", "__hash", "__counts")


def frequency_score(count: Column) -> Column:
    """2 from five occurrences on, 1 from three on."""
    return F.when(count >= 5, 2).when(count >= 3, 1).otherwise(0)


def position_score(lines: DataFrame, pack: NoisePack) -> DataFrame:
    """Adds position_score: 2 next to an edge of a chapter, 1 within four lines, else 0; null on headings."""
    heading = F.col("normal").rlike(pack.heading)
    in_book = Window.partitionBy("book").orderBy("position")
    numbered = lines.withColumn("is_heading", heading).withColumn("chapter", F.sum(F.col("is_heading").cast("int")).over(in_book))
    chapter = Window.partitionBy("book", "chapter", "is_heading")
    up = F.row_number().over(chapter.orderBy("position"))
    distance = F.least(up - 1, F.count("*").over(chapter) - up)
    score = F.when(distance <= 1, 2).when(distance <= 4, 1).otherwise(0)
    return numbered.withColumn("position_score", F.when(~F.col("is_heading"), score)).drop("is_heading", "chapter")


def hits(line: Column, words: tuple[str, ...], patterns: tuple[str, ...], pack: NoisePack) -> Column:
    """How many of the words and patterns a line has."""
    total = F.lit(0)
    for word in words:
        total = total + F.contains(line, F.lit(word)).cast("int")
    for pattern in patterns:
        total = total + has(line, pattern, pack).cast("int")
    return total


def any_hit(line: Column, words: tuple[str, ...], patterns: tuple[str, ...], pack: NoisePack) -> Column:
    """Whether a line has any of the words and patterns; the first that it has ends the search."""
    return reduce(or_, [F.contains(line, F.lit(word)) for word in words] + [has(line, pattern, pack) for pattern in patterns], F.lit(False))


def noise_tier(line: Column, pack: NoisePack) -> Column:
    """strong for any strong sign, weak for two weak ones, else clean."""
    return F.when(any_hit(line, pack.strong_words, pack.strong, pack), "strong").when(hits(line, pack.weak_words, pack.weak, pack) >= 2, "weak").otherwise("clean")


def prose_score(line: Column, pack: NoisePack) -> Column:
    """How much a line looks like prose."""
    total = F.lit(0)
    for pattern, points in pack.prose:
        total = total + F.when(has(line, pattern, pack), points).otherwise(0)
    return F.least(total, F.lit(pack.most_prose))


def scored(lines: DataFrame, pack: NoisePack) -> DataFrame:
    """Adds prose, tier and signs, the single signs of noise.

    Call it before lines are shuffled for their place or frequency: the patterns then run
    once a line, where later filters can't copy them into their own expressions.
    """
    line = F.col("normal")
    signs = lines.select("*", prose_score(line, pack).alias("prose"), any_hit(line, pack.strong_words, pack.strong, pack).alias("__strong"), hits(line, pack.weak_words, pack.weak, pack).alias("signs"))
    tier = F.when(F.col("__strong"), "strong").when(F.col("signs") >= 2, "weak").otherwise("clean")
    return signs.select(*lines.columns, "prose", tier.alias("tier"), "signs")


def classify(lines: DataFrame, pack: NoisePack) -> DataFrame:
    """Adds noise_score and verdict (keep, weak or strong) to scored lines with position_score and frequency.

    The rules are tried in order: headings and lines of one or two signs stay;
    repeated boilerplate goes; signs alone go unless prose protects them; tiers
    decide next, with prose softening them; then symbol-heavy and site-like lines;
    last, single weak signs count with place and repetition.
    """
    line = F.col("normal")
    length = F.length(line)
    of_script = F.regexp_count(line, F.lit(pack.script))
    alnum = F.regexp_count(line, F.lit("[A-Za-z0-9]"))
    letters = F.regexp_count(line, F.lit(r"[\p{L}\p{N}\s]"))
    symbol_share, alnum_share = (length - letters) / length, alnum / length
    frequency = frequency_score(F.coalesce("frequency", F.lit(0)))
    place = F.coalesce("position_score", F.lit(0))
    prose, tier = F.col("prose"), F.col("tier")
    soft = ((F.col("signs") > 0) & (place >= 1) & (prose <= 3)) | (has(line, pack.soft_meta, pack) & (prose <= 2))
    weak = (tier == "weak") | soft
    early = (
        F.when(line.rlike(pack.heading), "keep")
        .when((frequency > 0) & has(line, pack.boilerplate, pack), "strong")
        .when(length <= 2, "keep")
        .when(line.rlike(r"^[\p{N}\p{P}\p{S}\s]+$"), F.when(prose >= 4, "weak").otherwise("strong"))
        .when((tier == "strong") & (prose >= 2), "weak")
        .when(prose >= 4, F.when(tier == "clean", "keep").otherwise("weak"))
        .when(tier == "strong", "strong")
        .when((length < 50) & (symbol_share > 0.35) & (prose >= 2), "keep")
        .when((length < 50) & (symbol_share > 0.35) & (of_script == 0) & (alnum == 0), "strong")
        .when((length < 50) & (alnum_share > 0.6) & (of_script < 5) & (prose >= 2), "keep")
        .when((length < 50) & (alnum_share > 0.6) & (of_script < 5) & line.rlike(CODE_LINE), "strong")
    )
    late = F.when(weak & (place >= 2) & (frequency >= 1) & (prose <= 1), "strong").when(weak, "weak").otherwise("keep")
    noise = F.when(tier == "weak", 2).when(soft, 1).otherwise(0)
    return lines.withColumn("noise_score", F.when(noise > 0, noise + place + frequency).otherwise(0)).withColumn("verdict", F.coalesce(early, late))


def cleaning_summary(classified: DataFrame) -> DataFrame:
    """By book: lines, verdicts and their rates."""
    seen = F.count("*")
    return classified.groupBy("book").agg(
        seen.alias("lines_seen"), F.count_if(F.col("verdict") == "strong").alias("strong_dropped"), F.count_if(F.col("verdict") == "weak").alias("weak_candidates"), (F.count_if(F.col("verdict") == "strong") / seen).alias("discard_rate")
    )


def context(lines: DataFrame, radius: int = 2) -> DataFrame:
    """Adds context: the lines within ``radius`` raw places, blank ones left out."""
    near = Window.partitionBy("book").orderBy("position").rangeBetween(-radius, radius)
    return lines.withColumn("context", F.collect_list(stripped(F.col("line"))).over(near))
