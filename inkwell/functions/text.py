"""Column functions for text: normal forms, keys, identifiers, scores.

All are built-in expressions, so they stay in generated code and can be pushed
about by the optimizer. Null in, null out, unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings that stand for nothing. Fixed values.
EMPTY_LIKE = ("", "none", "null", "nil", "nan", "n/a", "na")
#: Strings that mean true. Fixed values.
TRUTHY = ("true", "1", "yes", "y", "是")
#: Full-width signs and what stands for them in a line. Fixed values.
WIDE, NARROW = "：（）【】　", ":()[] "


def stripped(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def unspaced(text: Column) -> Column:
    """Without white space of any script.

    Spaces and line feeds go without a pattern; others are looked for only beside signs that aren't plainly none.
    """
    plain = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return F.when(plain.rlike("[^!-~À-ɏ]"), F.regexp_replace(plain, r"(?U)\s+", "")).otherwise(plain)


def squeezed(text: Column) -> Column:
    """Stripped, with every run of white space as one space."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def collapsed_blank_lines(text: Column, most: int = 2) -> Column:
    """Runs of more than ``most`` line feeds cut to ``most``."""
    return F.regexp_replace(text, f"\n{{{most + 1},}}", "\n" * most)


def normal_text(text: Column, collapse: bool = True) -> Column:
    """Line feeds only, no ideographic spaces, at most one blank line in a row, stripped."""
    plain = F.replace(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), F.lit("　"), F.lit(" "))
    return stripped(collapsed_blank_lines(plain) if collapse else plain)


def normal_line(line: Column) -> Column:
    """A line with ASCII brackets and colons and single spaces.

    Most lines of Latin letters hold nothing to replace; that they hold nothing else and no two spaces is told quickly.
    """
    changed = line.contains("  ") | line.rlike("[^ -~À-ɏ]")
    return F.when(changed, squeezed(F.translate(line, WIDE, NARROW))).otherwise(F.trim(line))


def logical_text(text: Column) -> Column:
    """Without byte order marks, NULs and white space; expects composed text."""
    return F.regexp_replace(text, r"(?U)[\s\x{FEFF}\x{0000}]+", "")


def name_key(name: Column, edition: str = r"\s*(?:\(|（|第)?(?:edition|version|ver\.?|v)\s*\d+\)?$") -> Column:
    """Lower case letters and digits only, without an edition suffix."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), edition, ""), r"[^\p{L}\p{N}]", "")


def title_key(title: Column) -> Column:
    """A title for comparing across sites: no index, status, boilerplate or book marks."""
    # The four patterns and their order.
    key = F.regexp_replace(stripped(title), r"^\s*\d+\s*[.、]\s*", "")
    key = F.regexp_replace(key, r"[（(](?:全本|完本|连载中|已完结)[)）]\s*$", "")
    key = F.regexp_replace(key, "最新章节|全文阅读|免费阅读|txt下载|TXT下载", "")
    key = F.regexp_replace(key, "^《(.*)》$", "$1")
    return F.lower(squeezed(key))


def canonical_url(url: Column) -> Column:
    """scheme://host/path with the host in lower case, without port, query, fragment and final slashes."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    return F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path))


def content_number(identifier: Column) -> Column:
    """The number of idN, book_N, story_N or N; null for anything else."""
    digits = F.regexp_extract(F.trim(identifier), r"(?i)^(?:id|book_|story_)?(\d+)$", 1)
    return F.when(digits != "", digits.cast("long"))


def content_id(number: Column) -> Column:
    """idNNNNNN; an error outside six digits."""
    inside = (number >= 0) & (number < 1_000_000)
    return F.when(inside, F.format_string("id%06d", number)).otherwise(F.raise_error(F.lit("content id outside six digits")))


def chapter_id(content: Column, order: Column) -> Column:
    """idNNNNNNCNNNNNN."""
    return F.format_string("%sC%06d", content, order)


def file_name(name: Column, fallback: str = "unknown_book") -> Column:
    """A name that file systems take."""
    safe = F.regexp_replace(F.regexp_replace(name, r'[<>:"/\\|?*\n\r\t]+', "_"), r"^[ .]+|[ .]+$", "")
    return F.when(F.coalesce(safe, F.lit("")) == "", fallback).otherwise(safe)


def quoted_share(text: Column, quote: str = r'"([^"\n]{1,80})"') -> Column:
    """Characters in quotes, or in paragraphs that a quote opens if there are none, per character."""
    inside = F.aggregate(F.regexp_extract_all(text, F.lit(quote), 1), F.lit(0), lambda total, x: total + F.length(x))
    paragraphs = F.filter(F.transform(F.split(text, "\n"), stripped), lambda p: p.rlike("^[“\"']"))
    opened = F.aggregate(paragraphs, F.lit(0), lambda total, x: total + F.length(x))
    used = F.when(inside > 0, inside).otherwise(opened)
    return F.round(used / F.greatest(F.lit(1), F.length(F.replace(text, F.lit("\n"), F.lit("")))), 4)


def as_text(value: Column) -> Column:
    """Squeezed; "" for null and for words that stand for nothing."""
    text = F.coalesce(squeezed(value.cast("string")), F.lit(""))
    return F.when(F.lower(text).isin(*EMPTY_LIKE), "").otherwise(text)


def as_list(values: Column) -> Column:
    """Squeezed items without empty ones and repeats, in order of first occurrence; [] for null."""
    items = F.transform(values, lambda x: F.coalesce(squeezed(x), F.lit("")))
    return F.coalesce(F.array_distinct(F.filter(items, lambda x: x != "")), F.array().cast("array<string>"))


def as_int(value: Column) -> Column:
    """A whole number, or null."""
    return F.when(F.trim(value).rlike(r"^[+-]?\d+$"), F.trim(value).try_cast("long"))


def as_bool(value: Column) -> Column:
    """Whether a string means true; false for null."""
    return F.coalesce(F.lower(as_text(value)).isin(*TRUTHY), F.lit(False))


def paragraphs(text: Column) -> Column:
    """Stripped lines that hold something."""
    return F.filter(F.transform(F.split(text, "\n"), stripped), lambda p: p != "")


def char_grams(text: Column, size: int) -> Column:
    """Distinct character n-grams, from the text's array of characters, as a place in a string takes a walk to it."""
    count = F.length(text) - size + 1
    grams = lambda c: F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.concat(*[F.try_element_at(c, i + k) for k in range(size)]))
    found = F.element_at(F.transform(F.array(F.split(text, "")), grams), 1)
    return F.when(count > 0, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def jaccard(left: Column, right: Column) -> Column:
    """|A and B| / |A or B| of two arrays; 0 when both are empty."""
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(left, right)) / union)


def containment(left: Column, right: Column) -> Column:
    """|A and B| / the smaller size; 0 when one is empty."""
    smaller = F.least(F.size(left), F.size(right))
    return F.when(smaller == 0, 0.0).otherwise(F.size(F.array_intersect(left, right)) / smaller)


def size_ratio(left: Column, right: Column) -> Column:
    """The smaller over the larger; 1 when both are 0, 0 when one is."""
    most = F.greatest(left, right)
    return F.when(most == 0, 1.0).otherwise(F.least(left, right) / most)


def size_bucket(size: Column) -> Column:
    """Eighths of powers of two; 0 for sizes below 1."""
    return F.when(size < 1, 0).otherwise(F.floor(F.log2(size) * 8)).cast("long")


def story_form(chars: Column) -> Column:
    """By length: short_story below 30,000 characters, novelette below 80,000, else novella."""
    return F.when(chars < 30_000, "short_story").when(chars < 80_000, "novelette").otherwise("novella")


def work_class(chars: Column, parts: Column, discovered: Column) -> Column:
    """book for long texts, for fairly long ones of many parts, or where many parts were found; else story."""
    return F.when((chars >= 180_000) | ((chars >= 100_000) & (parts >= 8)) | (discovered >= 20), "book").otherwise("story")


def coverage(summary: Column, body: Column, size: int = 3) -> Column:
    """Character n-grams of ``body`` that ``summary`` has, per n-gram of ``body``."""
    grams = char_grams(body, size)
    return F.when(F.size(grams) == 0, 0.0).otherwise(F.size(F.array_intersect(grams, char_grams(summary, size))) / F.size(grams))
