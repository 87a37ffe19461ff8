"""Queries for sequential kernels and parsers; tests hold them against plain Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import kernels as K
from inkwell.operators import sequences as S
from inkwell.plans.registry import query, table
from inkwell.sources.html import sections


@query()
def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping chunks of whole paragraphs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(K.chunks("text", F.lit(1500), F.lit(200))).alias("c"))
    return docs.select("doc_id", "c.index", "c.start_char", "c.end_char", F.md5("c.text").alias("text_md5"))


@query()
def narrative_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrative units of long texts."""
    units = K.unit_splitter(1500, 2500, 400)("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(units).alias("unit", "text")).select("doc_id", "unit", F.length("text").alias("n_chars"))


@query()
def summary_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments cut at marks."""
    parts = K.segment_splitter(1000)("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(parts).alias("segment", "text")).select("doc_id", "segment", F.length("text").alias("n_chars"))


@query()
def sketch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order of what near-duplicate candidates share, of each group of equal sketches one."""
    from inkwell.plans.dedup_queries import near_dup_relations

    return near_dup_relations(spark, sf_dir).select("left", "right", "order")


@query()
def title_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN9: similarity of neighbouring names."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("a"))
    other = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b"))
    return part.join(other, "p_partkey").select("p_partkey", K.title_similarity("a", "b").alias("similarity"))


_PARTS = ((30, 120), (100, 160), (110, 130))


@query("""WITH n AS (SELECT source AS book, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS t FROM documents),
s AS (SELECT book, start, row_number() OVER (PARTITION BY book ORDER BY start) AS "window" FROM (SELECT DISTINCT book, CASE WHEN t <= 20 THEN 0 ELSE least(g * 10, t - 20) END AS start FROM (SELECT DISTINCT book, t, unnest(range(0, t // 10 + 1)) AS g FROM n))),
w AS (SELECT s.book, "window", list(doc_id ORDER BY doc_id) AS o FROM s JOIN n ON n.book = s.book AND i >= start AND i < start + 20 GROUP BY 1, 2),
g AS (SELECT book, "window", o, unnest([(30, 120), (100, 160), (110, 130)]) AS p FROM w),
h AS (SELECT book, "window", o, len(list_filter(o, lambda x: x < o[1] + p[1])) AS low, len(list_filter(o, lambda x: x <= o[1] + p[2])) - 1 AS high FROM g),
k AS (SELECT *, coalesce(max(high) OVER (PARTITION BY book, "window" ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS b FROM h WHERE low <= high),
own AS (SELECT * FROM k WHERE high > b),
e AS (SELECT w.book, w."window", w.o, len(w.o) AS low, len(w.o) AS high, coalesce(max(own.high), -1) AS b FROM w LEFT JOIN own ON own.book = w.book AND own."window" = w."window" GROUP BY 1, 2, 3)
SELECT book, "window"::INT AS "window", o[greatest(low, b + 1) + 1] AS "first", o[high + 1] AS "last", false AS gap FROM own
UNION ALL SELECT book, "window"::INT, o[b + 2], o[low], true FROM (SELECT * FROM own UNION ALL SELECT * FROM e) WHERE low > b + 1""")
def tiled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments repaired to tile their windows."""
    windows = S.sliding_windows(table(spark, sf_dir, "documents").withColumnRenamed("source", "book"), "book", "doc_id")
    parts = F.array(*[F.struct((F.col("first") + a).alias("first"), (F.col("first") + b).alias("last")) for a, b in _PARTS])
    segments = windows.select("book", "window", F.explode(parts).alias("s")).select("book", "window", "s.first", "s.last")
    return S.tiled(windows.select("book", "window", "orders"), segments, ["book", "window"])


@query()
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC17: title and visible text of pages."""
    return sections(table(spark, sf_dir, "pages"), "page_id", "html")
