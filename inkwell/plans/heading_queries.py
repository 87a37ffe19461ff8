"""Queries for numerals, headings and chapters; numerals and headings are set into the table's own texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import headings as H
from inkwell.plans.registry import query, table

_SIGNS = "〇一二三四五六七八九"


@query(f"""SELECT doc_id, translate(doc_id::VARCHAR, '0123456789', '{_SIGNS}') AS digits, doc_id AS by_digit,
(doc_id % 9 + 1) * 1000 + (doc_id // 9 % 9 + 1) * 100 + (doc_id // 81 % 9 + 1) * 10 + doc_id % 10 AS by_unit,
(doc_id % 9 + 1) * 100000 + 10000 AS bare_wan, (doc_id % 9 + 1) * 100000 AS title_wan FROM documents""")
def numerals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR16, PR17, FN23: numerals by digit, by unit, and the two rules for a 万 without a digit."""
    i = F.col("doc_id")
    sign = lambda n: F.translate(n.cast("string"), "0123456789", _SIGNS)
    digits = sign(i)
    thousands = F.concat(sign(i % 9 + 1), F.lit("千"), sign(F.expr("doc_id div 9 % 9 + 1")), F.lit("百"), sign(F.expr("doc_id div 81 % 9 + 1")), F.lit("十"), sign(i % 10))
    tens_of_wan = F.concat(sign(i % 9 + 1), F.lit("十万"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        digits.alias("digits"),
        H.numeral(digits).alias("by_digit"),
        H.numeral(thousands).alias("by_unit"),
        H.numeral(tens_of_wan).alias("bare_wan"),
        H.title_number(F.concat(F.lit("第 "), tens_of_wan, F.lit(" 章 x"))).alias("title_wan"),
    )


#: Headings set before some lines of each text: ordinary ones, repeats, lists of sections, volumes.
_LINES_SQL = """l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
x AS (SELECT doc_id, i, line, list_filter([CASE WHEN i % 24 = 10 THEN '第二卷 ' || left(line, 6) END, CASE WHEN i % 6 = 1 THEN '第' || (i // 6 + 1) || '章 ' || left(line, 8) END,
CASE WHEN i % 12 = 1 AND doc_id % 2 = 0 THEN '第' || (i // 6 + 1) || '章' || left(line, 8) END, CASE WHEN i % 18 = 4 THEN '第三节' END, CASE WHEN i % 18 = 4 AND doc_id % 3 > 0 THEN '第四节' END, line], lambda v: v IS NOT NULL) AS parts FROM l),
p AS (SELECT doc_id, i * 10 + generate_subscripts(parts, 1) AS place, trim(unnest(parts)) AS line FROM x)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, line = F.col("i"), F.col("line")
    numbered = F.concat(F.lit("第"), F.expr("i div 6 + 1").cast("string"), F.lit("章"))
    parts = F.array_compact(
        F.array(
            F.when(i % 24 == 10, F.concat(F.lit("第二卷 "), F.left(line, F.lit(6)))),
            F.when(i % 6 == 1, F.concat(numbered, F.lit(" "), F.left(line, F.lit(8)))),
            F.when((i % 12 == 1) & (F.col("doc_id") % 2 == 0), F.concat(numbered, F.left(line, F.lit(8)))),
            F.when(i % 18 == 4, F.lit("第三节")),
            F.when((i % 18 == 4) & (F.col("doc_id") % 3 > 0), F.lit("第四节")),
            line,
        )
    )
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return rows.select("doc_id", "i", F.posexplode(parts).alias("k", "line")).select("doc_id", (i * 10 + F.col("k") + 1).alias("place"), "line")


@query(rf"""WITH {_LINES_SQL},
t AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS r, regexp_matches(line, '{H.CHAPTER}') AS h, regexp_extract(line, '{H.CHAPTER}', 4) AS marker, regexp_extract(line, '{H.CHAPTER}', 3) AS num FROM p WHERE line <> ''),
w AS (SELECT *, r - row_number() OVER (PARTITION BY doc_id, h AND marker = '节' ORDER BY place) AS run FROM t),
k AS (SELECT *, CASE WHEN h AND NOT (marker = '节' AND count(*) OVER (PARTITION BY doc_id, h AND marker = '节', run) >= 2) THEN 'head' WHEN regexp_matches(line, '{H.VOLUME}') THEN 'volume' ELSE 'text' END AS kind FROM w),
b AS (SELECT *, lag(kind) OVER q AS pk, lag(num) OVER q AS pn, lag(regexp_replace(line, '[\s:：.\-_]+', '', 'g')) OVER q AS pw FROM k WHERE kind <> 'volume' WINDOW q AS (PARTITION BY doc_id ORDER BY place)),
o AS (SELECT doc_id, place, kind = 'head' AND NOT coalesce(pk = 'head' AND (pn = num OR pw = regexp_replace(line, '[\s:：.\-_]+', '', 'g')), false) AS opens FROM b),
c AS (SELECT k.*, sum(coalesce(opens, false)::INT) OVER (PARTITION BY k.doc_id ORDER BY k.place) AS chapter, max(CASE WHEN kind = 'volume' THEN k.place END) OVER (PARTITION BY k.doc_id ORDER BY k.place) AS vp FROM k LEFT JOIN o ON o.doc_id = k.doc_id AND o.place = k.place),
g AS (SELECT doc_id, chapter, arg_max(line, (length(line), -place)) FILTER (kind = 'head') AS raw, max(vp) AS vp, count(*) FILTER (kind = 'text') AS lines, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (kind = 'text'), '') AS content FROM c GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chapter) AS ord, count(*) OVER (PARTITION BY doc_id) AS many FROM g WHERE chapter > 0 OR lines > 0)
SELECT n.doc_id, ord::BIGINT AS ord, coalesce(raw, CASE WHEN many = 1 THEN 'preface' ELSE 'chapter_1' END) AS title, CASE left(raw, 3) WHEN '第三节' THEN 3 WHEN '第四节' THEN 4 ELSE TRY_CAST(regexp_extract(raw, '第([0-9]+)章', 1) AS BIGINT) END AS number,
CASE WHEN k.line IS NOT NULL THEN coalesce(nullif(replace(replace(trim(regexp_replace(regexp_extract(k.line, '{H.VOLUME}', 3), '\s+', ' ', 'g')), ' :', ':'), ' ：', '：'), ''), k.line) END AS volume, CASE WHEN k.line IS NOT NULL THEN 2 END::BIGINT AS volume_number, lines, md5(content) AS content_md5
FROM n LEFT JOIN k ON k.doc_id = n.doc_id AND k.place = n.vp""")
def split_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3, PR18, PR19: chapters of texts with headings, repeats, lists of sections and volumes."""
    found = H.chapters(_lines(spark, sf_dir), "doc_id", "place", "line")
    return found.select("doc_id", F.col("order").cast("long").alias("ord"), "title", "number", "volume", "volume_number", "lines", F.md5("content").alias("content_md5"))


@query("""SELECT page_id, CASE WHEN m = '' THEN 'unknown' ELSE m END AS component FROM (SELECT page_id, left(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '[^0-9a-z一-鿿_-]+', '-', 'g'), '-+', '-', 'g'), '^[-_.]+|[-_.]+$', '', 'g'), 80) AS m FROM pages)""")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR13: portable names from whole addresses."""
    return table(spark, sf_dir, "pages").select("page_id", H.component(F.col("url")).alias("component"))
