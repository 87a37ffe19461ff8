"""Queries for decisions on candidates. Documents stand for candidates, labels for a model's decisions, benchmark items for known patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import decisions as D
from inkwell.plans.registry import query, table

#: Words that show a stable system, of the made-up French.
_SYSTEM, _DIMENSIONS = ("tion", "ment"), {"rule": ("elle", "eaux"), "cost": ("oion",), "rank": ("entre",)}

_WORDS = "list_distinct(regexp_extract_all(lower({}), '[a-z0-9_]{{2,}}'))"
_GATE = f"""c AS (SELECT doc_id, lang AS library, source, text, coalesce(text, '') AS t, [lang, source] AS evidence, n_chars FROM documents),
q AS (SELECT 'item_' || item_id AS pattern_id, 'en' AS library, {_WORDS.format("text")} AS terms FROM benchmark),
said AS (SELECT c.*, CASE WHEN quality = 1 THEN 'create_new' WHEN toxic = 1 THEN 'reject' ELSE 'merge_existing' END AS said,
'item_' || (len(regexp_split_to_array(t, '[.!?]'))) AS target, split_part(t, chr(10), 1) AS name,
(contains(t, chr(10)))::INT + regexp_matches(t, '[0-9]')::INT + contains(t, '"')::INT AS ways, contains(t, chr(10)) AS differs, quality = 1 AS own FROM c JOIN labels USING (doc_id)),
pw AS (SELECT doc_id, library, w, unnest(w) AS term FROM (SELECT doc_id, library, {_WORDS.format("name || ' ' || t")} AS w FROM said WHERE said = 'create_new')), qw AS (SELECT pattern_id, library, terms, unnest(terms) AS term FROM q),
nj AS (SELECT doc_id, pattern_id, count(*) / (len(min(w)) + len(min(terms)) - count(*)) AS j FROM pw JOIN qw USING (library, term) GROUP BY 1, 2),
near AS (SELECT doc_id, min_by(pattern_id, (-j, substr(pattern_id, 6)::INT)) AS near_id FROM nj WHERE j >= .72 GROUP BY 1),
j AS (SELECT c.doc_id, c.library, said.said, target, own, CASE WHEN c.library = 'fr' THEN CASE WHEN NOT (contains(c.t, 'tion') OR contains(c.t, 'ment')) THEN 'worldview_missing_stable_rule_permission_or_resource_mechanism'
WHEN (contains(c.t, 'elle') OR contains(c.t, 'eaux'))::INT + contains(c.t, 'oion')::INT + contains(c.t, 'entre')::INT < 2 THEN 'worldview_requires_two_structural_system_dimensions'
WHEN c.n_chars / 2000 < .85 THEN 'worldview_two_plot_evidence_requires_high_confidence' END END AS unfit,
said.said = 'merge_existing' AND target NOT IN (SELECT pattern_id FROM q) AS lost, said.said = 'create_new' AND ways < 2 AS few, said.said = 'create_new' AND c.library IN (SELECT library FROM q) AND NOT differs AS silent,
said.said = 'create_new' AND (trim(name) = '' OR trim(said.t) = '') AS partial, near_id, said.said IS NULL AS omitted FROM c LEFT JOIN said USING (doc_id) LEFT JOIN near USING (doc_id)),
g AS (SELECT doc_id, library, target, CASE WHEN omitted OR lost OR few OR silent OR partial OR near_id IS NOT NULL OR (said <> 'reject' AND unfit IS NOT NULL) THEN 'needs_more_evidence' ELSE said END AS decision,
CASE WHEN omitted THEN 'missing_llm_decision' ELSE concat_ws(',', CASE WHEN lost THEN 'target_pattern_not_found' END, CASE WHEN few THEN 'fewer_than_two_structural_novelty_dimensions' END,
CASE WHEN silent THEN 'missing_nearest_pattern_differences' END, CASE WHEN partial THEN 'incomplete_proposed_pattern' END, 'local_near_duplicate:' || near_id,
CASE WHEN NOT (lost OR few OR silent OR partial OR near_id IS NOT NULL) AND said <> 'reject' THEN unfit END, CASE WHEN NOT own THEN 'invalid_decision_evidence_trimmed' END) END AS reasons FROM j)"""
_COMMIT = f"""{_GATE}, a AS (SELECT g.doc_id, g.library, decision, g.target, c.source AS book, lower(regexp_replace(split_part(t, chr(10), 1), '\\s+', '', 'g')) AS key, {_WORDS.format("split_part(t, chr(10), 1) || ' ' || t")} AS w
FROM g JOIN c USING (doc_id) WHERE decision IN ('create_new', 'merge_existing')), n AS (SELECT * FROM a WHERE decision = 'create_new' AND key <> ''), nw AS (SELECT doc_id, library, len(w) AS n, unnest(w) AS term FROM n),
e AS (SELECT l, r, max(s) AS s FROM (SELECT a.doc_id AS l, b.doc_id AS r, count(*) / (min(a.n) + min(b.n) - count(*)) AS s FROM nw a JOIN nw b ON a.library = b.library AND a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2
HAVING count(*) / (min(a.n) + min(b.n) - count(*)) >= .72 UNION ALL SELECT a.doc_id, b.doc_id, 2.0 FROM n a JOIN n b ON a.library = b.library AND a.key = b.key AND a.doc_id < b.doc_id) GROUP BY 1, 2),
todo AS (SELECT id, before, row_number() OVER (ORDER BY id) AS k FROM (SELECT r AS id, list(l) AS before FROM e GROUP BY 1)),
walk AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS follow UNION ALL SELECT walk.k + 1, CASE WHEN len(list_filter(todo.before, lambda v: NOT list_contains(walk.follow, v))) > 0 THEN list_append(walk.follow, todo.id) ELSE walk.follow END FROM walk JOIN todo ON todo.k = walk.k + 1),
f AS (SELECT unnest(follow) AS id FROM (SELECT follow FROM walk ORDER BY k DESC LIMIT 1)),
top AS (SELECT library, CASE library WHEN 'en' THEN (SELECT max(item_id) FROM benchmark) ELSE 0 END AS largest FROM (SELECT DISTINCT library FROM a)),
made AS (SELECT doc_id, library, 'emerging_pattern_' || lpad((largest + row_number() OVER (PARTITION BY library ORDER BY doc_id))::VARCHAR, 4, '0') AS pattern_id FROM n JOIN top USING (library) WHERE doc_id NOT IN (SELECT id FROM f)),
best AS (SELECT r AS doc_id, min_by(l, (-s, l)) AS leader FROM e WHERE r IN (SELECT id FROM f) AND l NOT IN (SELECT id FROM f) GROUP BY 1),
placed AS (SELECT a.library, a.book, CASE WHEN decision = 'merge_existing' THEN target ELSE made.pattern_id END AS pattern_id FROM a LEFT JOIN best USING (doc_id) LEFT JOIN made ON made.doc_id = coalesce(best.leader, a.doc_id))"""


def _gated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    unfit = F.when(F.col("lang") == "fr", D.system_evidence(text, F.array("lang", "source"), F.col("n_chars") / 2000, _SYSTEM, _DIMENSIONS))
    candidates = docs.select(F.col("doc_id").alias("candidate_id"), F.col("lang").alias("library"), F.array("lang", "source").alias("evidence"), unfit.alias("unfit"), "source", text.alias("text"), "n_chars")
    items = table(spark, sf_dir, "benchmark")
    none = F.array().cast("array<string>")
    patterns = items.select(
        F.concat(F.lit("item_"), "item_id").alias("pattern_id"), F.lit("en").alias("library"), F.concat(F.lit("item "), "item_id").alias("name"), D.pattern_terms(F.col("text")).alias("terms"), F.lit("universal").alias("layer"),
        F.col("item_id").alias("position"), F.lit(False).alias("made"), none.alias("axes"), none.alias("risks"), F.lit(0).cast("long").alias("books"), F.lit(0).cast("long").alias("instances"),
    )
    named = candidates.join(table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "candidate_id"), "candidate_id")
    good, lines = F.col("quality") == 1, F.contains("text", F.lit("\n"))
    novelty = F.array_compact(F.array(F.when(lines, "causal_order"), F.when(F.col("text").rlike("[0-9]"), "constraint_or_cost"), F.when(F.contains("text", F.lit('"')), "role_power_structure"), F.lit("setting")))
    decisions = named.select(
        "candidate_id", F.col("candidate_id").alias("position"), F.when(good, "create_new").when(F.col("toxic") == 1, "reject").otherwise("merge_existing").alias("decision"),
        F.concat(F.lit("item_"), F.size(F.split("text", "[.!?]"))).alias("target_id"), novelty.alias("novelty"), F.when(lines, F.array("source")).alias("differences"),
        F.when(good, F.array("source")).otherwise(F.array(F.lit("elsewhere"))).alias("evidence"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("name"), F.col("text").alias("mechanism"),
    )
    return D.gate(decisions, candidates, patterns), candidates, patterns


@query(f"WITH {_GATE} SELECT doc_id AS candidate_id, library, decision, reasons FROM g")
def decision_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FI13, FI16: what counts of the decisions on candidates, with reasons; candidates left out are added back."""
    return _gated(spark, sf_dir)[0].select("candidate_id", "library", "decision", F.array_join("reasons", ",").alias("reasons"))


@query(f"""WITH RECURSIVE {_COMMIT} SELECT pattern_id, library, layer, coalesce(books, 0) AS books, coalesce(instances, 0) AS instances FROM
(SELECT pattern_id, library, 'universal' AS layer FROM q UNION ALL SELECT pattern_id, library, 'emerging' FROM made) LEFT JOIN
(SELECT pattern_id, library, count(DISTINCT book) AS books, count(DISTINCT book) AS instances FROM placed GROUP BY 1, 2) USING (pattern_id, library)""")
def pattern_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD13, GD10: patterns with their support after the accepted decisions of all documents, the sources being the books."""
    gated, candidates, patterns = _gated(spark, sf_dir)
    text, none = F.col("text"), F.array().cast("array<string>")
    name = F.split_part("text", F.lit("\n"), F.lit(1))
    facts = candidates.select("candidate_id", F.col("candidate_id").alias("position"), F.col("source").alias("book"), name.alias("name"), D.pattern_terms(F.concat_ws(" ", name, text)).alias("terms"), F.least(F.lit(1.0), F.col("n_chars") / 10_000).alias("completeness"))
    live = gated.where("decision IN ('create_new', 'merge_existing', 'enrich_existing')").select("candidate_id", "library", "decision", "target_id")
    accepted = live.join(facts, "candidate_id").select("*", none.alias("axes"), none.alias("risks"), F.array("library", "book").alias("evidence"), F.lit(1).alias("grounded"))
    instances = spark.createDataFrame([], "instance_id string, library string, pattern_id string, book string, candidate_id string, evidence array<string>, grounded int, completeness double")
    support = spark.createDataFrame([], "pattern_id string, library string, book string")
    return D.commit(patterns, instances, support, accepted)[0]["patterns"].select("pattern_id", "library", "layer", "books", "instances")
