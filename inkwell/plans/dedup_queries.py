"""Queries for fingerprints, candidate pairs, relations and components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import unspaced
from inkwell.operators import fingerprint as P
from inkwell.operators import kernels as K
from inkwell.operators import works as W
from inkwell.operators.graph import connected_components
from inkwell.plans.registry import query, table
from inkwell.session import stored

_SKETCH = r"""s AS (SELECT id, unnest(b) AS sentence, generate_subscripts(b, 1) - 1 AS position FROM (SELECT doc_id AS id, flatten(list_transform(
list_transform(regexp_split_to_array(text, '[。！？!?；;.\n\r]+'), lambda x: trim(regexp_replace(x, '\s+', '', 'g'), '-_=*~·—…|【】[]()（）《》<>『』「」')),
lambda x: CASE WHEN length(x) > 320 THEN list_transform(range(0, length(x) - 79, 80), lambda i: substring(x, (i + 1)::INT, 160)) ELSE [x] END)) AS b FROM documents)),
h AS (SELECT *, CASE WHEN length(sentence) >= 18 AND NOT regexp_matches(sentence, 'https?://|www\.') THEN md5(sentence) END AS h FROM s),
p AS (SELECT id, position, md5(lag(h) OVER (PARTITION BY id ORDER BY position) || h) AS anchor FROM h),
f AS (SELECT id, anchor, min(position)::INT AS position FROM p WHERE anchor IS NOT NULL GROUP BY 1, 2),
k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY id ORDER BY anchor) <= 96)"""
_MEMBERS = r"""t AS (SELECT doc_id AS id, source AS title, lang AS author, n_chars, sha256(text) AS raw, regexp_replace(text, '\s+', '', 'g') AS plain FROM documents WHERE text IS NOT NULL),
m AS (SELECT id, title, author, n_chars, raw, sha256(plain) AS logical, length(plain) AS chars, min(id) OVER (PARTITION BY sha256(plain)) AS head FROM t)"""
_PAIRS = f"""{_SKETCH}, {_MEMBERS}, u AS (SELECT k.* FROM k JOIN m ON m.id = k.id AND m.head = m.id),
c AS (SELECT a.id AS l, b.id AS r, count(*) AS shared FROM u a JOIN u b ON a.anchor = b.anchor AND a.id < b.id GROUP BY 1, 2 HAVING count(*) >= 4)"""
_RELATED = f"""{_PAIRS}, lists AS (SELECT id, list(anchor ORDER BY anchor) AS a, list(anchor ORDER BY position) AS o FROM u GROUP BY 1),
z AS (SELECT c.l, c.r, x.a AS la, y.a AS ra, least(x.a[-1], y.a[-1]) AS m, list_filter(list_transform(x.o, lambda v: list_position(y.o, v)), lambda v: v > 0) AS places FROM c JOIN lists x ON x.id = c.l JOIN lists y ON y.id = c.r),
lis AS (SELECT l, r, places, 0 AS i, []::INT[] AS tails FROM z UNION ALL
SELECT l, r, places, i + 1, list_concat(list_filter(tails, lambda v: v < places[i + 1]), [places[i + 1]], list_filter(tails, lambda v: v > places[i + 1])[2:]) FROM lis WHERE i < len(places)),
g AS (SELECT l, r, list_filter(la, lambda v: v <= m) AS la, list_filter(ra, lambda v: v <= m) AS ra FROM z),
e AS (SELECT g.l, g.r, len(list_intersect(la, ra)) / len(list_distinct(list_concat(la, ra))) AS jaccard, len(list_intersect(la, ra)) / least(len(la), len(ra)) AS containment,
len(list_intersect(la, ra)) AS shared, len(tails) / len(places) AS "order" FROM g JOIN lis ON lis.l = g.l AND lis.r = g.r AND lis.i = len(places)),
d AS (SELECT e.*, least(a.chars, b.chars) AS chars, least(a.chars, b.chars) / greatest(a.chars, b.chars) AS length_ratio, a.title = b.title AS same_title,
a.title = b.title AND NOT (a.author <> '' AND b.author <> '' AND a.author <> b.author) AND a.chars <> b.chars AS shorter FROM e JOIN m a ON a.id = e.l JOIN m b ON b.id = e.r),
rel AS (SELECT l AS "left", r AS "right", shared, jaccard, containment, "order", length_ratio, CASE
WHEN chars >= 500 AND length_ratio >= .97 AND containment >= .96 AND jaccard >= .9 AND "order" >= .98 AND shared >= 10 THEN 'same_edition'
WHEN chars >= 500 AND length_ratio BETWEEN .45 AND .8 AND containment >= .99 AND "order" >= .99 AND shared >= 24 AND coalesce(shorter, false) THEN 'possible_incomplete'
WHEN chars >= 500 AND length_ratio >= .7 AND containment >= .92 AND "order" >= .95 AND shared >= 10 THEN 'same_work_version'
WHEN chars >= 500 AND containment >= .65 AND "order" >= .85 AND shared >= 5 THEN 'possible_same_work' WHEN same_title AND containment < .3 THEN 'title_collision' ELSE 'distinct' END AS relation FROM d)"""


def _sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.anchors(table(spark, sf_dir, "documents"), "doc_id", "text")


def _members(docs: DataFrame) -> DataFrame:
    """Documents that have a text, with the head, the smallest id, of those that are equal but for white space.

    What is known of each text is written first, so that texts are read and hashed once and not again for their heads.
    """
    known = docs.where("text IS NOT NULL").select("doc_id", "source", "lang", "n_chars", "text", unspaced(F.col("text")).alias("plain"))
    facts = stored(known.select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("lang").alias("author"), "n_chars",
        F.sha2("text", 256).alias("raw"), F.sha2("plain", 256).alias("logical"), F.length("plain").alias("chars"),
    ), "facts")
    return facts.join(facts.groupBy("logical").agg(F.min("id").alias("head"), F.count("*").alias("copies")), "logical")


def _head_sketch(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The sketches of heads, with anchors as bytes, which take half the room of their digits and sort alike."""
    return P.anchors(_head_texts(docs, members), "doc_id", "text").withColumn("anchor", F.unhex("anchor"))


def _head_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    return docs.join(members.where("id = head").select(F.col("id").alias("doc_id")), "doc_id", "left_semi")


def _lists(members: DataFrame, sketch: DataFrame) -> DataFrame:
    """The anchors of each head, sorted (a) and in the order of the text (o), with what else its relations need."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", "anchor"))), lambda x: x["anchor"])
    lists = sketch.groupBy("id").agg(F.array_sort(F.collect_list("anchor")).alias("a"), ordered.alias("o"))
    return stored(members.where("id = head").select("id", "title", "author", "chars").join(lists, "id"), "lists")


def _judged(pairs: DataFrame, lists: DataFrame, thresholds: P.Thresholds) -> DataFrame:
    """Evidence and relation of pairs of heads."""
    left, right = (lists.select([F.col(c).alias(f"{side}_{c}" if c != "id" else side) for c in lists.columns]) for side in ("left", "right"))
    both = pairs.join(left, "left").join(right, "right").withColumn("c", P.compared(F.col("left_a"), F.col("right_a")))
    same = F.coalesce(F.col("left_title") == F.col("right_title"), F.lit(False))
    ratio = F.least("left_chars", "right_chars") / F.greatest("left_chars", "right_chars")
    evidence = both.select(
        "left", "right", "c.*", K.order_ratio("left_o", "right_o").alias("order"), ratio.alias("length_ratio"), "left_chars", "right_chars", same.alias("same_title"),
        F.coalesce(P.consistent(same.cast("double")), F.lit(False)).alias("consistent"),
    )
    return evidence.select("left", "right", "shared", "jaccard", "containment", "order", "length_ratio", P.relation(thresholds).alias("relation"))


def _relations(members: DataFrame, sketch: DataFrame, thresholds: P.Thresholds) -> DataFrame:
    """Evidence and relation of the candidate pairs of heads."""
    return _judged(P.anchor_candidates(sketch).drop("shared"), _lists(members, sketch), thresholds)


def _related(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    members = stored(_members(docs), "members")
    sketch = stored(_head_sketch(docs, members), "sketch")
    return members, _relations(members, sketch, P.Thresholds(least_chars=500))


@query(f"WITH {_SKETCH} SELECT id, anchor, position FROM k")
def anchor_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD1, GD2, TK1, TK2: bottom-k sketches of neighbouring sentences, long ones in blocks."""
    return _sketch(spark, sf_dir)


@query(f"""WITH {_MEMBERS} SELECT m.id, m.head, CASE WHEN m.id = m.head THEN 'head' WHEN m.raw = h.raw THEN 'byte_exact' ELSE 'text_exact' END AS relation FROM m JOIN m h ON h.id = m.head""")
def near_dup_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD4, AG2: for which other document each document stands, and how they are equal; pairs are of heads only."""
    members = _members(table(spark, sf_dir, "documents"))
    heads = members.where("id = head").select("head", F.col("raw").alias("head_raw"))
    relation = F.when(F.col("id") == F.col("head"), "head").when(F.col("raw") == F.col("head_raw"), "byte_exact").otherwise("text_exact")
    return members.join(heads, "head").select("id", "head", relation.alias("relation"))


@query(f'WITH {_PAIRS} SELECT l AS "left", r AS "right", shared FROM c')
def near_dup_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different texts that share anchors, at any frequency of an anchor."""
    docs = table(spark, sf_dir, "documents")
    members = stored(_members(docs), "members")
    return P.anchor_candidates(_head_sketch(docs, members))


@query(f"WITH RECURSIVE {_RELATED} SELECT * FROM rel")
def near_dup_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD3, GD4, FI8, W15, SO2: evidence and relation of candidates; source stands for the title, lang for the author."""
    return _related(spark, sf_dir)[1]


@query(f"""WITH RECURSIVE {_RELATED}, edge AS (SELECT "left" AS a, "right" AS b FROM rel WHERE relation IN ('same_edition', 'possible_incomplete', 'same_work_version')),
same AS (SELECT a, b FROM edge UNION SELECT head, id FROM m WHERE id <> head), both_ways AS (SELECT a, b FROM same UNION SELECT b, a FROM same),
reach AS (SELECT a AS node, a AS other FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a)
SELECT node, min(other) AS component FROM reach GROUP BY 1""")
def near_dup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD5, SO3: what automatic relations connect; texts that are equal but for white space link with or without anchors."""
    docs = table(spark, sf_dir, "documents")
    members = stored(_members(docs), "members")
    sketch = stored(_head_sketch(docs, members), "sketch")
    lists = _lists(members, sketch)
    automatic = lambda pairs: _judged(pairs, lists, P.Thresholds(least_chars=500)).where(F.col("relation").isin(*P.AUTOMATIC))
    parts = P.linked_components(sketch, automatic, P.LEAST_AUTOMATIC).withColumnRenamed("node", "head")
    placed = members.join(parts, "head", "left").where("component IS NOT NULL OR copies > 1")
    return placed.select(F.col("id").alias("node"), F.coalesce("component", "head").alias("component"))


def _catalogue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    members, relations = _related(spark, sf_dir)
    quality = F.struct(F.when(F.col("author") == "en", 1).otherwise(0).alias("first"), "chars")
    return W.catalogue(members.select("id", "head", quality.alias("quality")), stored(relations.where("relation <> 'distinct'"), "relations"), P.AUTOMATIC)


@query()
def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD6, GD7, W19: the work, edition, action and version of every document, under complete link."""
    return _catalogue(spark, sf_dir)[0]


@query()
def work_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GD6: the edges between different texts, with those that complete link rejects as transitive_conflict."""
    return _catalogue(spark, sf_dir)[1]


@query("""WITH n AS (SELECT p_name, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY 1)
SELECT a.p_name, a.p_partkey AS "left", b.p_partkey AS "right" FROM part a JOIN n USING (p_name) JOIN part b ON a.p_name = b.p_name AND a.p_partkey < b.p_partkey WHERE n <= 64 OR a.p_partkey = first""")
def title_blocking_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with the same title key; those of a key of over 64 rows all with the first."""
    return P.key_pairs(table(spark, sf_dir, "part"), "p_name", "p_partkey")


@query("""SELECT sha256(text) AS content, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY CASE lang WHEN 'en' THEN 0 ELSE 1 END, n_chars DESC, doc_id) = 1""")
def representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK4, GD7: the best row of each group of equal texts."""
    docs = table(spark, sf_dir, "documents").withColumn("content", F.sha2("text", 256))
    return P.best_row(docs, "content", F.when(F.col("lang") == "en", 0).otherwise(1), F.desc("n_chars"), F.asc("doc_id")).select("content", "doc_id", "n_chars")


@query(r"""WITH d AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: length(x) > 6)) AS w FROM documents),
b AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: length(x) > 6)) AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS t FROM d), bw AS (SELECT item_id, len(w) AS n, unnest(w) AS t FROM b)
SELECT doc_id, item_id, count(*) AS shared, count(*) / min(n) AS contained FROM dw JOIN bw USING (t) GROUP BY 1, 2 HAVING count(*) >= 3""")
def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN5, SO2: how much of a benchmark item's long words a document holds."""
    words = lambda: F.array_distinct(F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: F.length(x) > 6))
    left = table(spark, sf_dir, "documents").select("doc_id", F.explode(words()).alias("t"))
    items = table(spark, sf_dir, "benchmark").select("item_id", words().alias("w"))
    right = items.select("item_id", F.size("w").alias("n"), F.explode("w").alias("t"))
    return left.join(right, "t").groupBy("doc_id", "item_id").agg(F.count("*").alias("shared"), (F.count("*") / F.min("n")).alias("contained")).where("shared >= 3")
