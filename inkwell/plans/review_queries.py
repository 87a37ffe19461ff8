"""Queries for rules over names, decisions, chapters, staged works and identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import review as R
from inkwell.plans.registry import query, table


@query("""SELECT p_partkey, name, CASE WHEN name IN ('cold widget', 'small widget') OR suffix(name, '模板') THEN 'generic_pattern_name' WHEN name = '' OR contains(name, '+') OR len(string_split(name, '、')) > 2 THEN 'tag_joined_pattern_name' END AS rejection
FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '+') WHEN 2 THEN replace(p_name, ' ', '、') WHEN 3 THEN p_name || '模板' ELSE replace(p_name, ' ', '、') || '、' || p_type END AS name FROM part)""")
def name_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FI12: names that are generic or tags put together."""
    k, name = F.col("p_partkey") % 5, F.col("p_name")
    listed = F.replace(name, F.lit(" "), F.lit("、"))
    made = F.when(k == 0, name).when(k == 1, F.replace(name, F.lit(" "), F.lit("+"))).when(k == 2, listed).when(k == 3, F.concat(name, F.lit("模板"))).otherwise(F.concat(listed, F.lit("、"), "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", made.alias("name")).withColumn("rejection", R.name_rejection(F.col("name"), ["cold widget", "small widget"]))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN 'retain' WHEN l_n > 4 AND c >= .85 AND o_custkey % 2 = 0 THEN 'recommend_remove_after_audit' WHEN c >= .85 THEN 'secondary_review' ELSE 'retain_pending_review' END AS action,
CASE WHEN o_orderstatus <> 'F' THEN 'model_did_not_find_candidate_incomplete' WHEN l_n > 4 AND c >= .85 AND o_custkey % 2 = 0 THEN 'direct_containment_and_high_confidence_model_agree' WHEN c >= .85 THEN 'model_only_incomplete_signal_cannot_delete' ELSE 'incomplete_confidence_below_guard_threshold' END AS reason
FROM (SELECT o.*, (o_orderkey % 40) / 40 AS c, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS l_n FROM orders o)""")
def guarded_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FI14: what a finding may lead to, with evidence of its own joined."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    decision = F.when(F.col("o_orderstatus") == "F", "candidate_incomplete").otherwise("other")
    action = R.guarded_action(decision, (F.col("o_orderkey") % 40) / 40, F.coalesce(F.col("n") > 4, F.lit(False)), F.col("o_custkey") % 2 == 0)
    return rows.select("o_orderkey", action.alias("a")).select("o_orderkey", "a.action", "a.reason")


@query("""SELECT doc_id, round(CASE WHEN length(text) = 0 THEN -1 ELSE (1 - (length(text) - length(regexp_replace(text, '[^\\PC\r\n\t]|[^\\PZ ]', '', 'g'))) / length(text)) * .4
+ (length(text) - length(regexp_replace(text, '[㐀-鿿豈-﫿]', '', 'g'))) / length(text) * .6 - (length(text) - length(replace(text, '�', ''))) / length(text) * 2 END, 9) AS score FROM documents""")
def decoded_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN8: the score of decoded texts."""
    return table(spark, sf_dir, "documents").select("doc_id", F.round(R.decoded_score(F.col("text")), 9).alias("score"))


@query("""SELECT doc_id, len(a) AS n_words, len(b) AS n_long, md5(array_to_string(list_sort(a), ' ')) AS words_md5 FROM
(SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS a, list_distinct(regexp_extract_all(lower(text), '[a-z0-9_]{2,}')) AS b FROM documents)""")
def term_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN6: terms of whole texts by two of the extractors."""
    rows = table(spark, sf_dir, "documents").select("doc_id", R.terms(F.col("text")).alias("a"), R.terms(F.col("text"), 2, (2,)).alias("b"))
    return rows.select("doc_id", F.size("a").cast("long").alias("n_words"), F.size("b").cast("long").alias("n_long"), F.md5(F.array_join(F.array_sort("a"), " ")).alias("words_md5"))


_KNOWN = [("tool", 0, ["widget", "gear", "cold"]), ("part", 1, ["bolt", "small", "red"]), ("gadget", 2, ["gadget", "large", "cold", "small"])]


@query("""WITH k AS (SELECT * FROM (VALUES ('tool', 0, ['widget', 'gear', 'cold']), ('part', 1, ['bolt', 'small', 'red']), ('gadget', 2, ['gadget', 'large', 'cold', 'small'])) t(archetype, position, terms)),
s AS (SELECT p_partkey, archetype, position, len(list_filter(terms, lambda t: contains(p_name, t))) AS held FROM part, k), b AS (SELECT p_partkey, arg_max(archetype, (held, -position)) AS archetype, max(held) AS held FROM s WHERE held >= 2 GROUP BY 1)
SELECT part.p_partkey, archetype, held::INT AS held FROM part LEFT JOIN b USING (p_partkey)""")
def name_archetypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN22: archetypes by the terms that names hold."""
    return R.archetypes(table(spark, sf_dir, "part"), "p_partkey", "p_name", spark.createDataFrame(_KNOWN, "archetype string, position int, terms array<string>"))


@query("""WITH c AS (SELECT conv_id, CASE WHEN turn % 7 = 5 THEN turn - 1 ELSE turn END - (conv_id % 9 = 0)::INT AS ord, CASE WHEN turn % 11 = 3 THEN '' ELSE conv_id || '/' || turn END AS id, CASE WHEN turn % 13 = 4 THEN NULL ELSE role END AS title, count(*) OVER (PARTITION BY conv_id) + (conv_id % 5 = 0)::INT AS e FROM conversations),
f AS (SELECT conv_id, list_filter([CASE WHEN bool_or(ord <= 0) THEN 'order_not_positive' END, CASE WHEN count(DISTINCT ord) < count(ord) THEN 'duplicate_order' END, CASE WHEN bool_or(id = '') THEN 'missing_id' END, CASE WHEN count(DISTINCT id) < count(id) THEN 'duplicate_id' END,
CASE WHEN bool_or(title IS NULL) THEN 'missing_title' END, CASE WHEN max(e) <> count(*) THEN 'count_mismatch' END], lambda x: x IS NOT NULL) AS f, count(*) AS chapters FROM c GROUP BY 1) SELECT conv_id, array_to_string(f, ',') AS faults, chapters FROM f WHERE len(f) > 0""")
def chapter_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT14: invariants of books; orders, ids, titles and counts of conversations are bent for it."""
    turn = F.col("turn")
    counts = table(spark, sf_dir, "conversations").groupBy("conv_id").agg((F.count("*") + (F.col("conv_id") % 5 == 0).cast("int")).alias("expected"))
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id",
        (F.when(turn % 7 == 5, turn - 1).otherwise(turn) - (F.col("conv_id") % 9 == 0).cast("int")).alias("ord"),
        F.when(turn % 11 == 3, "").otherwise(F.concat_ws("/", "conv_id", "turn")).alias("id"),
        F.when(turn % 13 != 4, F.col("role")).alias("title"),
    )
    found = R.chapter_faults(rows.join(counts, "conv_id"), "conv_id", "ord", "id", "title", F.col("expected"))
    return found.select("conv_id", F.array_join("faults", ",").alias("faults"), "chapters")


@query("""WITH h AS (SELECT coalesce(p.o, f.o) AS l_orderkey, p.o IS NOT NULL AS listed, complete, bytes FROM (SELECT l_orderkey AS o, l_linenumber AS n, l_returnflag <> 'R' OR l_linestatus <> 'F' AS complete FROM lineitem WHERE l_orderkey % 17 > 0 OR l_linenumber > 1) p
FULL JOIN (SELECT l_orderkey AS o, l_linenumber AS n, (l_quantity - 1)::BIGINT AS bytes FROM lineitem WHERE l_suppkey % 6 > 0) f ON p.o = f.o AND p.n = f.n),
c AS (SELECT l_orderkey, count(*) FILTER (complete) / greatest(count(*) FILTER (listed), 1) AS ratio, count(*) FILTER (listed AND bytes IS NULL) AS missing, count(*) FILTER (NOT listed) AS extra, count(*) FILTER (bytes = 0) AS empty FROM h GROUP BY 1)
SELECT *, ratio >= .98 AND missing = 0 AND extra = 0 AND empty = 0 AS ready FROM c""")
def promotion_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT15: staged works (orders) whose parts and files allow to publish them."""
    lines = table(spark, sf_dir, "lineitem")
    parts = lines.where("l_orderkey % 17 > 0 OR l_linenumber > 1").select("l_orderkey", "l_linenumber", ((F.col("l_returnflag") != "R") | (F.col("l_linestatus") != "F")).alias("complete"))
    files = lines.where("l_suppkey % 6 > 0").select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 1).cast("long").alias("bytes"))
    return R.promotion(parts, files, "l_orderkey", "l_linenumber")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY coalesce(nullif(left(o_orderpriority, 1), '3'), '99'), coalesce(o_orderpriority, ''), '', o_custkey, 0, o_orderkey) AS index_rank,
row_number() OVER (PARTITION BY o_orderstatus ORDER BY (o_orderpriority = '5-LOW')::INT, o_orderkey) AS last_rank FROM orders""")
def plan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK3: plan rows in the order of the index, and with duplicates last."""
    first = F.left("o_orderpriority", F.lit(1))
    plan = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("run"), F.col("o_orderkey").alias("file_id"), F.when(first != "3", first).alias("category"), F.col("o_orderpriority").alias("title_key"), F.lit(None).cast("string").alias("author_key"),
        F.col("o_custkey").alias("library_id"), F.lit(None).cast("int").alias("version"), F.col("o_orderpriority").alias("action"),
    )
    both = R.index_order(plan).withColumnRenamed("rank", "index_rank")
    return R.index_order(both, "5-LOW").select(F.col("file_id").alias("o_orderkey"), F.col("index_rank").cast("long").alias("index_rank"), F.col("rank").cast("long").alias("last_rank"))


@query("""WITH m AS (SELECT o_custkey AS c_custkey, min(o_orderkey) AS canonical, count(*) AS n FROM orders WHERE o_orderkey % 9 = 0 GROUP BY 1), r AS (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal < 2000)
SELECT c_custkey, canonical, CASE WHEN n > 1 OR (canonical IS NOT NULL AND r.c_custkey IS NOT NULL) THEN 'conflict' WHEN canonical IS NOT NULL THEN 'mapped' WHEN r.c_custkey IS NOT NULL THEN 'retired' ELSE 'unresolved' END AS state
FROM customer LEFT JOIN m USING (c_custkey) LEFT JOIN r USING (c_custkey)""")
def identity_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT22: one row for each legacy identity (customer)."""
    customers = table(spark, sf_dir, "customer")
    mapped = table(spark, sf_dir, "orders").where("o_orderkey % 9 = 0").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("canonical"))
    return R.lineage(customers, mapped, customers.where("c_acctbal < 2000"), "c_custkey")


@query(r"""WITH w AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(text, '[\p{L}\p{M}\p{Nd}\p{Pc}]{2,}')) AS w, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
s AS (SELECT a.conv_id, a.turn, list_distinct(flatten(list(b.w) FILTER (b.n < a.n))) AS l, list_distinct(flatten(list(b.w) FILTER (b.n >= a.n))) AS r FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.n BETWEEN a.n - 4 AND a.n + 4 WHERE a.n > 1 GROUP BY 1, 2),
o AS (SELECT conv_id, turn, len(list_intersect(l, r)) / greatest(len(list_distinct(list_concat(l, r))), 1) AS overlap FROM s)
SELECT conv_id, turn, overlap, overlap < .22 AS split, round(greatest(.2, least(.85, 1 - overlap)), 6) AS confidence FROM o""")
def boundary_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN7: where the words of neighbouring turns change."""
    return R.boundary_overlap(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")
