"""Queries for projections, scalar functions and predicates on text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.plans.registry import query, table


@query(r"""SELECT doc_id, md5(n) AS text_md5, length(n) AS n_chars FROM (SELECT doc_id,
regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(text, chr(13)||chr(10), chr(10)), chr(13), chr(10)), '　', ' '), '\n{3,}', chr(10)||chr(10), 'g'), '^\s+', ''), '\s+$', '') AS n FROM documents)""")
def normal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR1: normal line ends, blank lines and ends."""
    n = T.normal_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(n).alias("text_md5"), F.length(n).cast("long").alias("n_chars"))


@query(r"""SELECT doc_id, md5(string_agg(trim(regexp_replace(translate(l, '：（）【】　', ':()[] '), '\s+', ' ', 'g')), chr(10) ORDER BY i)) AS lines_md5
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) GROUP BY 1""")
def normal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR2: lines with single spaces and ASCII brackets."""
    lines = F.transform(F.split("text", "\n"), T.normal_line)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.array_join(lines, "\n")).alias("lines_md5"))


@query(r"""SELECT doc_id, length(regexp_replace(text, '\n{2,}', chr(10), 'g')) AS n_chars FROM documents""")
def collapsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR3: runs of line feeds cut to one."""
    return table(spark, sf_dir, "documents").select("doc_id", F.length(T.collapsed_blank_lines(F.col("text"), 1)).cast("long").alias("n_chars"))


@query(r"""SELECT sha256(regexp_replace(text, '\s+', '', 'g')) AS logical_hash, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents GROUP BY 1""")
def logical_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR4: hashes of texts without white space."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.logical_text(F.col("text")), 256).alias("logical_hash"))
    return docs.groupBy("logical_hash").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query(r"""SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '\s*(?:edition|version|ver\.?|v)\s*\d+\)?$', ''), '[^\p{L}\p{N}]', '', 'g') AS name_key FROM part""")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR8: names as letters and digits."""
    return table(spark, sf_dir, "part").select("p_partkey", T.name_key(F.col("p_name")).alias("name_key"))


@query(r"""SELECT p_partkey, lower(trim(regexp_replace(p_name || ' 全文阅读', '最新章节|全文阅读', '', 'g'))) AS title_key FROM part""")
def title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR9: title keys without index, status and book marks."""
    dressed = F.concat(F.col("p_partkey").cast("string"), F.lit(". 《"), F.col("p_name"), F.lit(" 全文阅读》(全本)"))
    return table(spark, sf_dir, "part").select("p_partkey", T.title_key(dressed).alias("title_key"))


@query(r"""SELECT page_id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) ||
CASE WHEN rtrim(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') = '' THEN '/' ELSE rtrim(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') END AS canonical FROM pages""")
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR10: canonical URLs."""
    return table(spark, sf_dir, "pages").select("page_id", T.canonical_url(F.col("url")).alias("canonical"))


@query("""SELECT conv_id, turn, 'id' || lpad(conv_id::VARCHAR, 6, '0') AS content_id, 'id' || lpad(conv_id::VARCHAR, 6, '0') || 'C' || lpad((turn + 1)::VARCHAR, 6, '0') AS chapter_id FROM conversations""")
def chapter_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR11: identifiers of content and chapters, parsed from a legacy form."""
    number = T.content_number(F.concat(F.lit("book_"), F.col("conv_id").cast("string")))
    content = T.content_id(number)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", content.alias("content_id"), T.chapter_id(content, F.col("turn") + 1).alias("chapter_id"))


@query(r"""SELECT page_id, trim(regexp_replace(url, '[<>:"/\\|?*\n\r\t]+', '_', 'g'), ' .') AS file_name FROM pages""")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR12: names for files."""
    return table(spark, sf_dir, "pages").select("page_id", T.file_name(F.col("url")).alias("file_name"))


@query(r"""SELECT doc_id, round(coalesce(list_sum([length(x) for x in regexp_extract_all(q, '"([^"\n]{1,80})"', 1)]), 0) / greatest(1, length(replace(q, chr(10), ''))), 4) AS quoted_share
FROM (SELECT doc_id, regexp_replace(text, '(\w+), (\w+)', '"\1" \2', 'g') AS q FROM documents) WHERE regexp_matches(q, '"[^"\n]{1,80}"')""")
def quoted_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR20: share of characters in quotes; the word before a comma is quoted for the test."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"([0-9A-Za-z_]+), ([0-9A-Za-z_]+)", '"$1" $2').alias("q"))
    return docs.where(F.col("q").rlike('"[^"\n]{1,80}"')).select("doc_id", T.quoted_share(F.col("q")).alias("quoted_share"))


@query(r"""SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS as_text, CAST(json_extract_string(props, '$.k') AS BIGINT) AS as_int,
(event_id % 3 = 0) AS as_bool FROM events""")
def coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN1, FN3: tolerant text, numbers and truth."""
    words = F.when(F.col("event_type") == "error", " N/A ").otherwise(F.concat(F.lit("  "), "event_type", F.lit(" ")))
    truth = F.element_at(F.array(F.lit("Yes"), F.lit("no"), F.lit(None).cast("string")), (F.col("event_id") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        "event_id", T.as_text(words).alias("as_text"), T.as_int(F.get_json_object("props", "$.k")).alias("as_int"), T.as_bool(truth).alias("as_bool")
    )


@query(r"""SELECT doc_id, len(list_distinct(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))) AS n_items FROM documents""")
def distinct_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN2, SO1: squeezed items without repeats."""
    items = T.as_list(F.split("text", r"(?U)\s+"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(items).cast("long").alias("n_items"))


@query(r"""WITH d AS (SELECT doc_id, string_split(lower(text), '') AS c FROM documents), g AS (
SELECT doc_id, list_distinct([c[i::BIGINT] || c[i::BIGINT + 1] || c[i::BIGINT + 2] for i in range(1, len(c) - 1)]) AS g FROM d)
SELECT a.doc_id, len(a.g) AS n_grams, CASE WHEN len(list_distinct(list_concat(a.g, b.g))) = 0 THEN 0.0 ELSE len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))) END AS jaccard
FROM g a JOIN g b ON b.doc_id = a.doc_id + 1""")
def gram_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN5, SO2: Jaccard of character 3-grams of neighbouring documents, over whole texts."""
    grams = table(spark, sf_dir, "documents").select("doc_id", T.char_grams(F.lower("text"), 3).alias("g"))
    other = grams.select((F.col("doc_id") - 1).alias("doc_id"), F.col("g").alias("h"))
    return grams.join(other, "doc_id").select("doc_id", F.size("g").cast("long").alias("n_grams"), T.jaccard(F.col("g"), F.col("h")).alias("jaccard"))


@query("""SELECT doc_id, CASE WHEN n_chars < 1 THEN 0 ELSE floor(log2(n_chars) * 8) END::BIGINT AS bucket, least(n_chars, 1000) / greatest(n_chars, 1000) AS ratio,
CASE WHEN n_chars * 20 < 30000 THEN 'short_story' WHEN n_chars * 20 < 80000 THEN 'novelette' ELSE 'novella' END AS form,
CASE WHEN n_chars * 50 >= 180000 OR (n_chars * 50 >= 100000 AND doc_id % 10 >= 8) OR doc_id % 25 >= 20 THEN 'book' ELSE 'story' END AS class FROM documents""")
def size_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN10, FN20, FN21: sizes, ratios and forms by length."""
    chars = F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        T.size_bucket(chars).alias("bucket"),
        T.size_ratio(chars, F.lit(1000)).alias("ratio"),
        T.story_form(chars * 20).alias("form"),
        T.work_class(chars * 50, F.col("doc_id") % 10, F.col("doc_id") % 25).alias("class"),
    )


@query("""SELECT doc_id, 'doc:' || substr(sha1(source || '/' || doc_id::VARCHAR), 1, 12) AS node_id, substr(sha256(text), 1, 16) || '-' || substr(sha256(source), 1, 8) AS source_id FROM documents""")
def hashed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN11: identifiers from hashes."""
    node = F.concat(F.lit("doc:"), F.substring(F.sha1(F.concat_ws("/", "source", F.col("doc_id").cast("string"))), 1, 12))
    source = F.concat(F.substring(F.sha2("text", 256), 1, 16), F.lit("-"), F.substring(F.sha2("source", 256), 1, 8))
    return table(spark, sf_dir, "documents").select("doc_id", node.alias("node_id"), source.alias("source_id"))


@query(r"""SELECT doc_id, len(p) AS n_paragraphs, coalesce(list_max([length(x) for x in p]), 0) AS longest FROM (SELECT doc_id, list_filter([trim(x) for x in string_split(text, chr(10))], lambda x: x <> '') AS p FROM documents)""")
def paragraph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN24: paragraphs of texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", T.paragraphs(F.col("text")).alias("p"))
    longest = F.coalesce(F.array_max(F.transform("p", F.length)), F.lit(0))
    return docs.select("doc_id", F.size("p").cast("long").alias("n_paragraphs"), longest.cast("long").alias("longest"))
