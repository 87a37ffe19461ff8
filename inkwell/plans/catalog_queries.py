"""Queries for catalog state, joins between stages, and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import catalog as C
from inkwell.plans.registry import query, table


@query("""SELECT o.o_orderkey FROM orders o JOIN (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey + (o_orderkey % 5 = 0)::INT END AS c, o_totalprice FROM orders) s
ON o.o_orderkey = s.o_orderkey AND o.o_totalprice = s.o_totalprice AND (s.c = 0 OR s.c = o.o_custkey)""")
def identity_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC3, J4: rows whose stored identity still holds, with 0 as unknown."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    old = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey") + (F.col("o_orderkey") % 5 == 0).cast("int")))
    return C.unchanged(orders, old, "o_orderkey", ["o_totalprice"], ["o_custkey"]).select("o_orderkey")


@query("""WITH new AS (SELECT user_id, max_by(event_type, event_id) AS state, max(event_id) AS event_id FROM events WHERE event_id % 2 = 0 GROUP BY 1),
old AS (SELECT DISTINCT user_id, 'old' AS state, -1::BIGINT AS event_id FROM events) SELECT user_id, state, event_id FROM new UNION ALL SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM new)""")
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC4: newest rows replace old ones."""
    events = table(spark, sf_dir, "events")
    old = events.select("user_id", F.lit("old").alias("state"), F.lit(-1).cast("long").alias("event_id")).distinct()
    new = events.where("event_id % 2 = 0").select("user_id", F.col("event_type").alias("state"), "event_id")
    return C.upsert(old, new, "user_id", "event_id")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 2) AND o_orderkey % 10 <> 0 THEN 'missing' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def missing_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC5: rows that a scan no longer sees."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    seen = table(spark, sf_dir, "lineitem").where("l_linenumber > 2").select(F.col("l_orderkey").alias("o_orderkey"))
    return C.mark_missing(orders, seen, orders.where("o_orderkey % 10 = 0"), "o_orderkey", "o_orderstatus")


@query("""SELECT source, sha256(string_agg(h, '' ORDER BY h)) AS digest, count(*) AS n FROM (SELECT source, sha256(doc_id || '|' || n_chars || '|' || lang) AS h FROM documents) GROUP BY 1""")
def stability_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC6: a digest of each source's files."""
    return C.snapshot(table(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", "lang")


@query("""SELECT doc_id, rank::BIGINT AS rank FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rank, count(*) OVER () AS t FROM documents) WHERE rank IN (SELECT i * (t - 1) // 16 FROM (SELECT unnest(range(17)) AS i))""")
def spread_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC20: rows evenly over the inventory."""
    return C.spread_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 17)


@query("""WITH m AS (SELECT o_orderkey AS k, count(*) AS listed FROM orders WHERE o_orderkey % 17 <> 0 GROUP BY 1), f AS (SELECT l_orderkey AS k, count(*) AS found FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)
SELECT k, coalesce(listed, 0) AS listed, coalesce(found, 0) AS found, CASE WHEN listed IS NULL THEN 'extra' WHEN found IS NULL THEN 'missing' WHEN listed > 1 THEN 'repeated' ELSE 'ok' END AS issue FROM m FULL JOIN f USING (k)""")
def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC13, J7, CT23: a manifest against what is there."""
    manifest = table(spark, sf_dir, "orders").where("o_orderkey % 17 <> 0").select(F.col("o_orderkey").alias("k"))
    found = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("k"))
    return C.reconcile(manifest, found, "k")


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS stage FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def cross_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with what another stage says of them."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", F.lit(True).alias("known"))
    stage = F.when(F.col("known").isNull(), "unlabelled").when(F.col("toxic") == 1, "toxic").otherwise("clean")
    return table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").select("doc_id", stage.alias("stage"))


@query("""SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def stage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9, SC22: keys that the next stage lacks."""
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("""SELECT doc_id, md5(text) AS signature FROM documents WHERE NOT (doc_id % 3 = 0 OR (doc_id % 5 = 0 AND lang = 'en'))""")
def stale_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3, ST4, UD9: work whose signature isn't among what is done."""
    work = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("signature"), "lang")
    done = work.where("doc_id % 3 = 0 OR (doc_id % 5 = 0 AND lang = 'en')").union(work.where("doc_id % 2 = 0").withColumn("signature", F.lit("old")))
    return C.stale(work.drop("lang"), done, ["doc_id", "signature"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 0 ELSE 1 END AS tier, sum(o_totalprice) AS size FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY 1, 2 HAVING count(*) BETWEEN 2 AND 40""")
def queue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10, FI10, TK6, CT24: an eligible queue, curated rows first, then the smallest."""
    joined = table(spark, sf_dir, "customer").where("c_mktsegment <> 'HOUSEHOLD'").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    sized = joined.groupBy("c_custkey").agg(F.sum("o_totalprice").alias("size"), F.count("*").alias("n")).where(F.col("n").between(2, 40)).drop("n")
    rank = F.when(F.col("c_custkey") % 50 == 0, F.col("c_custkey"))
    return C.queue(sized, rank, F.col("size"), "c_custkey")


@query("""SELECT doc_id, (doc_id * 1103515245 + 42) % 2147483647 AS place FROM documents WHERE lang = 'en' AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id AND quality = 1) ORDER BY place, doc_id LIMIT 25""")
def lcg_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FI9: candidates in a fixed pseudo-random order."""
    labelled = table(spark, sf_dir, "labels").where("quality = 1")
    place = C.pseudo_random_order(F.col("doc_id"), 42)
    return table(spark, sf_dir, "documents").where("lang = 'en'").join(labelled, "doc_id", "left_semi").select("doc_id", place.alias("place")).orderBy("place", "doc_id").limit(25)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 8 <> 0 THEN 'done' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def guarded_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT2, CT3, CT6: status changes under guards; null keeps the old."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    key = F.col("o_orderkey")
    changes = orders.where("o_orderkey % 4 = 0").select("o_orderkey", F.when(key % 3 == 0, -1).otherwise(F.col("o_custkey")).alias("o_custkey"), F.when(key % 8 != 0, "done").alias("o_orderstatus"))
    return C.transition(orders, changes, "o_orderkey", ["o_custkey"], "o_orderstatus").drop("o_custkey")


@query("""SELECT 'run-1' AS run_id, doc_id, '{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || '}' AS document FROM documents""")
def frozen_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT1: an immutable snapshot of rows as JSON."""
    return C.frozen(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "run-1", "doc_id")


@query("""SELECT event_type, count(*) AS n, sum(value) AS total, count(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def status_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG1: counts and sums by status."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.countDistinct("user_id").alias("users"))


@query("""SELECT user_id, count(*) AS n, min(event_id) AS first_seen FROM events GROUP BY 1 ORDER BY n DESC, first_seen LIMIT 10""")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG12: the most frequent values, ties in order of first occurrence."""
    return C.top_values(table(spark, sf_dir, "events"), "user_id", "event_id", 10)


@query("""SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1""")
def first_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG22, SC22: distinct keys by first occurrence."""
    return C.first_occurrences(table(spark, sf_dir, "events"), "user_id", "event_id")


@query()
def approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG4: approximate distinct counts and frequent values; tests hold them against exact ones."""
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", 0.02).alias("orders"), F.expr("approx_top_k(l_partkey, 5, 1000)").alias("parts"))


@query("""WITH known AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) * 10 AS id FROM part WHERE p_partkey % 11 = 0), g AS (SELECT p_name AS name, min(id) AS id FROM part LEFT JOIN known USING (p_partkey) GROUP BY 1)
SELECT name, CASE WHEN id IS NOT NULL THEN id ELSE (SELECT max(id) FROM known) + row_number() OVER (PARTITION BY id IS NULL ORDER BY name) END AS id FROM g""")
def reused_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J15, J16, CT11 in part: groups take a known id, else the next."""
    rows = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), "p_partkey")
    known, _ = C.ranks(rows.where("p_partkey % 11 = 0").select("p_partkey"), "p_partkey")
    return C.reuse_ids(rows, known.select("p_partkey", ((F.col("rank") + 1) * 10).alias("id")), "name", "p_partkey", "id")


@query("""WITH r AS (SELECT source, doc_id, n_chars, max(n_chars) OVER (PARTITION BY source) AS longest, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents)
SELECT source, doc_id, rank::INT AS rank, n_chars / longest AS share, CASE WHEN rank = 1 THEN 'keep' WHEN n_chars / longest >= .97 THEN 'same_length' WHEN n_chars / longest >= .8 THEN 'shorter' ELSE 'truncated' END AS fate FROM r""")
def version_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG19, CT21: editions of a work by length."""
    return C.version_decisions(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars").drop("n_chars", "longest")


@query()
def archive_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC26: shards bounded by rows and bytes; tests hold them against a plain loop."""
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.octet_length("text").cast("long").alias("size"))
    return C.bounded_shards(rows, "source", "doc_id", "size", 20, 30_000)


@query("""SELECT user_id, event_id, ts FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 600 SECOND""")
def stable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6, SC2: rows older than the stability window."""
    events = table(spark, sf_dir, "events")
    newest = events.agg(F.max("ts").alias("newest"))
    return events.join(F.broadcast(newest), F.col("ts") < F.col("newest") - F.expr("INTERVAL 600 SECONDS")).select("user_id", "event_id", "ts")


@query("""SELECT c_custkey, coalesce(o.n, 0) AS n, CASE WHEN o.n IS NULL THEN 'no_output' WHEN o.n < 3 THEN 'short' ELSE 'ok' END AS issue FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def registry_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8, AG11 in part: a registry against its outputs."""
    outputs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    issue = F.when(F.col("n").isNull(), "no_output").when(F.col("n") < 3, "short").otherwise("ok")
    return table(spark, sf_dir, "customer").select("c_custkey").join(outputs, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), issue.alias("issue"))


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_extendedprice DESC) = 1""")
def tidy_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SO4: the last entry of each order."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.max_by("l_extendedprice", F.struct("l_partkey", "l_extendedprice")).alias("l_extendedprice"))


@query("""SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def contained_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SO6, J6, PT12: ids that the other side publishes."""
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(rich, "o_custkey", "left_semi").select("o_orderkey")
