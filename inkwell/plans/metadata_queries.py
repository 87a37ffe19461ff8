"""Queries for names, genres, rankings and tolerant JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import metadata as M
from inkwell.plans.registry import query, table

_RULES = [("red", "red", 1.0), ("red", "ring", 0.4), ("small", "small", 1.2), ("blue", "blue", 1.0), ("blue", "widget", 0.5)]
_POINTS = " UNION ALL ".join(f"SELECT p_partkey, '{g}' AS genre, {s * 1.7!r}::DOUBLE * contains(p_name, '{w}')::INT + {s * 0.34!r}::DOUBLE * contains(lower(p_type), '{w}')::INT AS points FROM part" for g, w, s in _RULES)


@query("""SELECT * FROM (VALUES ('a/《山海》作者：王五.txt', '山海', '王五', 0.99), ('夜行 作者 李四.txt', '夜行', '李四', 0.9154), ('风-张三.txt', '风', '张三', 0.6128), ('独行.txt', '独行', NULL, 0.74)) t(raw, title, author, confidence)""".replace("0.99)", "0.99::DOUBLE)").replace("0.9154)", "0.9154::DOUBLE)"))
def book_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR7 in part: titles and authors from file names."""
    rows = spark.createDataFrame([(x,) for x in ("a/《山海》作者：王五.txt", "夜行 作者 李四.txt", "风-张三.txt", "独行.txt")], "raw string")
    return rows.select("raw", M.book_name(F.col("raw")).alias("n")).select("raw", "n.title", "n.author", "n.confidence")


@query(f"""WITH s AS (SELECT p_partkey, genre, sum(points) AS score FROM ({_POINTS}) GROUP BY 1, 2 HAVING sum(points) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, list_position(['red', 'small', 'blue'], genre)) AS rank FROM s),
b AS (SELECT p.p_partkey, x.genre, x.score AS top, x.score - coalesce(y.score, 0) AS lead FROM part p LEFT JOIN r x ON x.p_partkey = p.p_partkey AND x.rank = 1 LEFT JOIN r y ON y.p_partkey = p.p_partkey AND y.rank = 2)
SELECT p_partkey, CASE WHEN top >= .9 THEN genre ELSE '其他' END AS genre, round(CASE WHEN top >= .9 THEN greatest(.2::DOUBLE, least(.98::DOUBLE, .40::DOUBLE + least(.40::DOUBLE, .07::DOUBLE * top) + least(.14::DOUBLE, .035::DOUBLE * lead) - CASE WHEN lead < .8 THEN .12::DOUBLE ELSE 0 END)) ELSE .2 END, 6) AS confidence FROM b""")
def genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN12, PR15: genres by weighted keywords."""
    part = table(spark, sf_dir, "part")
    scores = M.genre_scores(part, "p_partkey", _RULES, {"title": F.col("p_name"), "excerpt": F.lower("p_type")})
    return M.classified_genres(part, "p_partkey", scores, ["red", "small", "blue"]).withColumn("confidence", F.round("confidence", 6))


@query("""WITH b AS (SELECT user_id, event_type, CASE event_id % 3 WHEN 0 THEN 'filename' WHEN 1 THEN 'head' ELSE 'path' END AS source, max(event_id % 10 / 10) AS c FROM events GROUP BY 1, 2, 3),
s AS (SELECT user_id, event_type, sum(c) + CASE WHEN bool_or(source = 'filename') AND bool_or(source = 'head') THEN .12::DOUBLE ELSE 0 END AS score FROM b GROUP BY 1, 2)
SELECT user_id, event_type, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, event_type) = 1""")
def field_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK8: the best value of a field over sources."""
    source = F.element_at(F.array(*map(F.lit, ("filename", "head", "path"))), (F.col("event_id") % 3 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", source.alias("source"), (F.col("event_id") % 10 / 10).alias("c0"))
    best = M.ranked_candidates(rows, "user_id", "event_type", "source", "c0", ("filename", "head"))
    return best.withColumn("score", F.round("score", 6))


@query("""WITH r AS (SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 OR turn % 3 = 0 THEN 100 - turn END AS number FROM conversations),
m AS (SELECT *, count(number) OVER (PARTITION BY conv_id) >= greatest(3, .6 * count(*) OVER (PARTITION BY conv_id)) AS enough FROM r)
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN enough THEN coalesce(number, 1152921504606846976) ELSE 0 END, turn)::INT AS place FROM m""")
def numbered_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK5: chapters by number where most have one."""
    number = F.when((F.col("conv_id") % 2 == 0) | (F.col("turn") % 3 == 0), 100 - F.col("turn"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", number.alias("number"))
    return M.ordered_by_number(rows, "conv_id", "turn", "number").drop("number")


@query("""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE props END AS object FROM events""")
def json_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN4: JSON objects out of fenced or wordy answers."""
    shape = F.col("event_id") % 4
    answer = F.when(shape == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(shape == 1, F.concat(F.lit("Sure: "), "props", F.lit(" done."))).when(shape == 2, F.col("props")).otherwise(F.lit("no {json"))
    return table(spark, sf_dir, "events").select("event_id", M.json_object(answer).alias("object"))


_ANSWERS = r"""o AS (SELECT doc_id, lang, '{"id": ' || doc_id || ', "more": {"a": ["}", "\\"]}, "body": ' || to_json({'text': coalesce(text, '')}) || '}' AS object FROM documents),
a AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'Sure: ' || object || ' and "more} of it {"n": 1}' WHEN 'de' THEN chr(10) || '```json' || chr(10) || object || chr(10) || '```' WHEN 'es' THEN object || chr(10) ELSE left(object, length(object) - 1) END AS answer FROM o),
b AS (SELECT doc_id, answer, regexp_replace(answer, '(?s)^\s*```(?:json)?\s*|\s*```\s*$', '', 'g') AS bare FROM a), t AS (SELECT *, substr(bare, instr(bare, '{')) AS tail FROM b),
p AS (SELECT doc_id, unnest(x) AS piece, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, regexp_extract_all(tail, '\\(?s:.)|["{}]|[^\\"{}]+|\\') AS x FROM t)),
q AS (SELECT *, sum((piece = '"')::INT) OVER w % 2 AS quoted, sum(length(piece)) OVER w AS upto FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
d AS (SELECT *, sum(CASE WHEN quoted = 0 THEN (piece = '{')::INT - (piece = '}')::INT ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM q),
e AS (SELECT doc_id, min(upto) AS upto FROM d WHERE depth = 0 GROUP BY 1)"""


@query(f"""WITH {_ANSWERS}, f AS (SELECT t.doc_id, CASE WHEN upto IS NOT NULL AND json_valid(left(tail, upto::INT)) THEN left(tail, upto::INT) END AS object,
CASE WHEN regexp_matches(trim(answer, chr(10)), '(?s)^\\{{.*\\}}$') AND json_valid(answer) THEN trim(answer, chr(10)) END AS strict FROM t LEFT JOIN e USING (doc_id))
SELECT doc_id, md5(object) AS object_md5, length(object) AS n_chars, strict IS NOT NULL AS strict FROM f""")
def answer_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN4: the first balanced object of answers that hold whole documents: wordy with a second object, fenced, strict and cut off ones."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    body = F.concat(F.lit('{"id": '), F.col("doc_id"), F.lit(', "more": {"a": ["}", "\\\\"]}, "body": '), F.to_json(F.struct("text")), F.lit("}"))
    made = docs.select("doc_id", "lang", body.alias("object"))
    answer = (
        F.when(F.col("lang") == "en", F.concat(F.lit("Sure: "), "object", F.lit(' and "more} of it {"n": 1}'))).when(F.col("lang") == "de", F.concat(F.lit("\n```json\n"), "object", F.lit("\n```")))
        .when(F.col("lang") == "es", F.concat("object", F.lit("\n"))).otherwise(F.expr("left(object, length(object) - 1)"))
    )
    found = made.select("doc_id", answer.alias("answer")).select("doc_id", M.json_object(F.col("answer")).alias("object"), M.strict_json(F.col("answer")).isNotNull().alias("strict"))
    return found.select("doc_id", F.md5("object").alias("object_md5"), F.length("object").cast("long").alias("n_chars"), "strict")


@query(r"""SELECT page_id, len(regexp_extract_all(html, '/[a-z]+/[0-9]+|track\([0-9]+\)')) AS n, regexp_extract(html, '/[a-z]+/[0-9]+|track\([0-9]+\)') AS "first" FROM pages WHERE regexp_matches(html, '/[a-z]+/[0-9]+|track\([0-9]+\)')""")
def stale_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT20, PR26: texts that name old identities."""
    return M.stale_tokens(table(spark, sf_dir, "pages"), "page_id", "html", r"/[a-z]+/[0-9]+|track\([0-9]+\)")


@query("""WITH m AS (SELECT l_orderkey, list(l_suppkey ORDER BY l_linenumber) AS s FROM lineitem GROUP BY 1) SELECT l_orderkey, len(list_distinct(s)) >= 2 AND len(list_distinct(s)) = len(s) AS allowed FROM m""")
def allowed_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SO5: groups that hold several books and none twice."""
    members = F.collect_list(F.array("l_suppkey"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(members.alias("m")).select("l_orderkey", M.group_allowed(F.col("m")).alias("allowed"))


@query(r"""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN text WHEN turn % 3 = 1 THEN role ELSE array_to_string(list_slice(regexp_split_to_array(text, '\. '), 1, 3), '；') END AS synopsis FROM conversations""")
def synopses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR25 in part: the first text that is there."""
    turn = F.col("turn") % 3
    made = M.synopsis(F.when(turn == 0, F.col("text")), F.when(turn == 1, F.col("role")), F.split("text", r"\. "))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", made.alias("synopsis"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') THEN 'published' ELSE 'pending' END AS label, o_orderstatus = 'F' AS source_deleted FROM orders""")
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR22: what transfer states mean."""
    return table(spark, sf_dir, "orders").select("o_orderkey", M.outcome(F.col("o_orderstatus")).alias("o")).select("o_orderkey", "o.label", "o.source_deleted")
