"""Queries for ordered rows: windows, sessions, boundaries, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import sequences as S
from inkwell.plans.registry import query, table
from inkwell.session import stored

_N = "n AS (SELECT source AS book, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS t FROM documents)"


def _starts(size: int, step: int, pull_back: bool) -> str:
    if pull_back:
        return f"s AS (SELECT DISTINCT book, t, CASE WHEN t <= {size} THEN 0 ELSE least(g * {step}, t - {size}) END AS start FROM (SELECT DISTINCT book, t, unnest(range(0, t // {step} + 1)) AS g FROM n))"
    return f"s AS (SELECT DISTINCT book, t, g * {step} AS start FROM (SELECT DISTINCT book, t, unnest(range(0, CASE WHEN t <= {size} THEN 1 ELSE ceil((t - {size}) / {step})::BIGINT + 1 END)) AS g FROM n))"


def _windows(size: int, step: int, pull_back: bool) -> str:
    return f"""WITH {_N}, {_starts(size, step, pull_back)}, w AS (SELECT book, start, t, row_number() OVER (PARTITION BY book ORDER BY start) AS "window" FROM s)
SELECT w.book, w.start::INT AS start, w."window", min(doc_id) AS "first", max(doc_id) AS "last", count(*) AS "rows" FROM w JOIN n ON n.book = w.book AND i >= w.start AND i < w.start + {size} GROUP BY 1, 2, 3"""


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumnRenamed("source", "book")


@query(_windows(20, 10, True))
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 by 10 with the tail pulled back."""
    return S.sliding_windows(_books(spark, sf_dir), "book", "doc_id").drop("orders")


@query(_windows(4, 3, False))
def evidence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 4 that share one row."""
    return S.sliding_windows(_books(spark, sf_dir), "book", "doc_id", 4, 1, 0, False).drop("orders")


@query("""WITH f AS (SELECT *, role = 'user' AS o, coalesce(lag(role = 'user') OVER (PARTITION BY conv_id ORDER BY turn), false) AS p FROM conversations),
s AS (SELECT *, sum((o AND NOT p)::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS session FROM f)
SELECT conv_id, session::BIGINT AS session, min(turn) AS first_turn, count(*) AS turns, sum(length(text))::BIGINT AS chars FROM s GROUP BY 1, 2""")
def chapter_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that headings (user turns) open."""
    rows = S.sessions(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "user")
    return rows.groupBy("conv_id", "session").agg(F.min("turn").alias("first_turn"), F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"))


@query(r"""WITH c AS (SELECT conv_id, turn + (turn > 3)::INT AS ord, length(text) * (turn % 5 <> 4)::INT AS chars, len(list_filter([trim(x) for x in string_split(text, chr(10))], lambda x: x <> '')) AS paras FROM conversations),
e AS (SELECT *, coalesce(lag(ord) OVER w + 1, 1) AS expected, avg(CASE WHEN chars > 0 THEN chars END) OVER (PARTITION BY conv_id) AS m FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY ord)),
r AS (SELECT conv_id, ord, concat_ws(',', CASE WHEN ord <> expected THEN 'non_contiguous_order_expected_' || expected END, CASE WHEN chars = 0 THEN 'empty_content' WHEN chars < 80 THEN 'very_short_content'
WHEN chars < m * .12 THEN 'short_length_outlier' WHEN chars > m * 4 THEN 'long_length_outlier' END, CASE WHEN paras <= 1 AND chars > 300 THEN 'single_paragraph_long_chapter' END) AS reasons FROM e)
SELECT * FROM r WHERE reasons <> ''""")
def chapter_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspicious chapters; orders skip one and some are emptied for the test."""
    from inkwell.functions.text import paragraphs

    t = F.col("turn")
    rows = table(spark, sf_dir, "conversations").select("conv_id", (t + (t > 3).cast("int")).alias("ord"), (F.length("text") * (t % 5 != 4).cast("int")).alias("chars"), F.size(paragraphs(F.col("text"))).alias("paras"))
    return S.anomalies(rows, "conv_id", "ord", "chars", "paras").select("conv_id", "ord", F.array_join("reasons", ",").alias("reasons"))


_VOTES = f"""WITH {_N}, {_starts(20, 10, True)}, wl AS (SELECT s.book, s.start, doc_id, n_chars, row_number() OVER (PARTITION BY s.book, s.start ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY s.book, s.start) AS c FROM s JOIN n ON n.book = s.book AND i >= s.start AND i < s.start + 20),
ch AS (SELECT book, doc_id AS boundary, count(*) AS opportunities FROM wl WHERE k < c GROUP BY 1, 2),
ends AS (SELECT book, doc_id AS boundary, (CASE WHEN n_chars % 2 = 0 THEN .5 ELSE .75 END * CASE WHEN n_chars % 3 = 0 THEN .65 ELSE 1.0 END)::DOUBLE AS votes, 0 AS hard, 0 AS strong, 0 AS forbid FROM wl WHERE n_chars % 7 = 0 AND k < c),
cand AS (SELECT book, doc_id AS boundary, (CASE n_chars % 11 WHEN 0 THEN 1.5 WHEN 1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS votes, (n_chars % 11 = 0)::INT AS hard, (n_chars % 11 = 1)::INT AS strong, (n_chars % 11 = 2)::INT AS forbid FROM wl WHERE n_chars % 11 < 3),
uns AS (SELECT book, doc_id AS boundary, .25::DOUBLE AS votes, 0 AS hard, 0 AS strong, 0 AS forbid FROM wl WHERE n_chars % 13 = 0),
v AS (SELECT book, boundary, sum(votes) AS votes, sum(hard)::BIGINT AS hard, sum(strong)::BIGINT AS strong, sum(forbid)::BIGINT AS forbid FROM (SELECT * FROM ends UNION ALL SELECT * FROM cand UNION ALL SELECT * FROM uns) GROUP BY 1, 2),
vs AS (SELECT v.*, opportunities, votes / opportunities AS support FROM v JOIN ch USING (book, boundary)),
sel AS (SELECT *, NOT forbid > greatest(hard, strong) AND ((hard > 0 AND forbid = 0) OR (votes >= 2 AND support >= .55) OR (support >= .8 AND votes >= 1)) AS selected FROM vs)"""


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes that follow from lengths, in place of a model's answers."""
    windows = S.sliding_windows(_books(spark, sf_dir), "book", "doc_id").select("book", "window", "orders", "last")
    members = windows.select("book", "window", "last", F.explode("orders").alias("doc_id")).join(_books(spark, sf_dir).select("doc_id", "n_chars"), "doc_id")
    n = F.col("n_chars")
    segments = members.where(n % 7 == 0).select("book", F.col("doc_id").alias("end"), (n % 2 == 0).alias("uncertain_after"), F.lit(False).alias("next_uncertain_before"), F.when(n % 3 == 0, "setup").otherwise("main").alias("level"), F.col("last").alias("last_end"))
    named = F.element_at(F.array(*map(F.lit, ("hard", "strong", "forbid"))), (n % 11 + 1).cast("int"))
    candidates = members.where(n % 11 < 3).select("book", F.col("doc_id").alias("boundary"), named.alias("strength"), F.lit(True).alias("split"))
    unsure = members.where(n % 13 == 0).select("book", F.col("doc_id").alias("boundary"))
    return S.boundary_votes(segments, candidates, unsure, windows, "book").withColumn("selected", S.selected())


@query(f"{_VOTES} SELECT * FROM sel")
def boundary_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG9, W8: weighted votes and the boundaries that they select."""
    return _votes(spark, sf_dir)


@query(f"""{_VOTES}, m AS (SELECT n.book, n.doc_id, coalesce(sum(coalesce(selected, false)::INT) OVER (PARTITION BY n.book ORDER BY n.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS plot
FROM n LEFT JOIN sel ON sel.book = n.book AND sel.boundary = n.doc_id) SELECT book, plot::BIGINT AS plot, count(*) AS chapters, min(doc_id) AS "first", max(doc_id) AS "last" FROM m GROUP BY 1, 2""")
def plot_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plots between selected boundaries."""
    plots = S.cut(_books(spark, sf_dir).select("book", "doc_id"), _votes(spark, sf_dir).where("selected"), "book", "doc_id")
    return plots.groupBy("book", "plot").agg(F.count("*").alias("chapters"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query(f"""WITH {_N}, {_starts(20, 10, True)}, p AS (SELECT book, i // 7 AS plot, doc_id FROM n), w AS (SELECT n.book, s.start AS "window", (i - s.start) // 6 AS segment, doc_id FROM s JOIN n ON n.book = s.book AND i >= s.start AND i < s.start + 20),
pn AS (SELECT book, plot, count(*) AS na FROM p GROUP BY 1, 2), wn AS (SELECT book, "window", segment, count(*) AS nb FROM w GROUP BY 1, 2, 3),
j AS (SELECT p.book, plot, "window", segment, count(*) AS k FROM p JOIN w ON p.book = w.book AND p.doc_id = w.doc_id GROUP BY 1, 2, 3, 4)
SELECT book, plot::BIGINT AS plot, "window"::INT AS "window", segment::BIGINT AS segment, k / (na + nb - k) AS jaccard FROM j JOIN pn USING (book, plot) JOIN wn USING (book, "window", segment)
QUALIFY row_number() OVER (PARTITION BY book, plot, "window" ORDER BY k / (na + nb - k) DESC, segment) = 1""")
def segment_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment of each window that overlaps a plot best."""
    numbered = S.ordinals(_books(spark, sf_dir).select("book", "doc_id"), "book", "doc_id")
    plots = numbered.groupBy("book", F.expr("index div 7").alias("plot")).agg(F.collect_list("doc_id").alias("orders"))
    windows = S.sliding_windows(_books(spark, sf_dir), "book", "doc_id").select("book", F.col("start").alias("window"), F.posexplode("orders").alias("k", "doc_id"))
    segments = windows.groupBy("book", "window", F.expr("k div 6").alias("segment")).agg(F.collect_list("doc_id").alias("orders"))
    return S.overlaps(plots, segments, "book")


@query("""WITH r AS (SELECT source AS book, count(*) AS chapters, avg(n_chars) AS mean_chars, quantile_disc(n_chars, .9)::BIGINT AS p90_chars, max(n_chars) AS most_chars, sum(n_chars)::BIGINT AS total_chars FROM documents GROUP BY 1)
SELECT *, CASE WHEN mean_chars > 8000 OR p90_chars > 12000 OR (chapters < 300 AND total_chars >= 1500000) THEN 'long' ELSE 'regular' END AS shape FROM r""")
def book_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG8, AG5, AG10: lengths of chapters by book."""
    return S.shape(_books(spark, sf_dir), "book", "n_chars")


@query("SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of each user."""
    return S.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type"), "user_id", "ts", "event_id")


@query("""WITH e AS (SELECT DISTINCT source AS work, doc_id AS edition FROM documents), k AS (SELECT work, edition, row_number() OVER (PARTITION BY work ORDER BY edition DESC) AS version FROM e WHERE edition % 7 = 0),
j AS (SELECT e.*, version FROM e LEFT JOIN k USING (work, edition)), m AS (SELECT *, coalesce(max(version) OVER (PARTITION BY work), 0) AS l, row_number() OVER (PARTITION BY work, version IS NULL ORDER BY edition) AS t FROM j)
SELECT work, edition, coalesce(version, l + t) AS version FROM m""")
def stable_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known version numbers stay, new ones follow."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("work"), F.col("doc_id").alias("edition"))
    known = rows.where("edition % 7 = 0").withColumn("version", F.row_number().over(Window.partitionBy("work").orderBy(F.desc("edition"))).cast("long"))
    return S.versions(rows, known, "work", "edition").withColumn("version", F.col("version").cast("long"))


@query(f"""WITH {_N} SELECT book, CASE WHEN (i + 1) / t <= .1 THEN 'opening' WHEN (i + 1) / t <= .35 THEN 'rise' WHEN (i + 1) / t <= .6 THEN 'middle' WHEN (i + 1) / t <= .82 THEN 'turn' ELSE 'ending' END AS phase, count(*) AS n FROM n GROUP BY 1, 2""")
def phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters by phase of the book."""
    placed = S.ordinals(_books(spark, sf_dir).select("book", "doc_id"), "book", "doc_id")
    return placed.groupBy("book", S.phase(F.col("index"), F.col("total")).alias("phase")).agg(F.count("*").alias("n"))


@query(f"""WITH {_N} SELECT doc_id, sum(n_chars) OVER (PARTITION BY book ORDER BY doc_id)::BIGINT - n_chars AS char_start, sum(n_chars) OVER (PARTITION BY book ORDER BY doc_id)::BIGINT AS char_end, i + 1 AS unit FROM n""")
def unit_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W14, SC27: units numbered through a book, with offsets."""
    from pyspark.sql import Window

    placed = S.ordinals(_books(spark, sf_dir), "book", "doc_id")
    end = F.sum("n_chars").over(Window.partitionBy("book").orderBy("doc_id"))
    return placed.select("doc_id", (end - F.col("n_chars")).alias("char_start"), end.alias("char_end"), (F.col("index") + 1).cast("long").alias("unit"))


def _answers(lines: DataFrame):
    """What lines' lengths, commas and first letters say about windows of a text's lines, in place of a model's answers."""

    def analyse(windows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        spread = windows.select("segment", "window", "last", F.explode("orders").alias("position"))
        members = spread.join(lines, (F.col("segment.doc_id") == F.col("doc_id")) & (spread["position"] == lines["position"])).drop(lines["position"])
        size, comma = F.col("size"), F.col("comma")
        ends = members.where(comma & (size < 120)).select("segment", F.col("position").alias("end"), (size < 60).alias("uncertain_after"), (size > 100).alias("next_uncertain_before"), F.when(F.col("early"), "setup").otherwise("main").alias("level"), F.col("last").alias("last_end"))
        strength = F.when(size < 13, "hard").when(size < 25, "strong").when(size < 40, "forbid").otherwise("weak")
        candidates = members.where(size < 100).select("segment", F.col("position").alias("boundary"), strength.alias("strength"), (~comma).alias("split"))
        return ends, candidates, members.where(size > 600).select("segment", F.col("position").alias("boundary"))

    return analyse


def _text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents that aren't blank: doc_id, position, size, comma, early."""
    split = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    return split.where("trim(line) <> ''").select("doc_id", "position", F.length("line").alias("size"), F.contains("line", F.lit(",")).alias("comma"), F.col("line").rlike("^[A-M]").alias("early"))


@query()
def refined_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each text in segments of at most 24, cut again where they are longer; a test holds it against a plain recursion."""
    lines = stored(_text_lines(spark, sf_dir), "text-lines")
    begun = lines.groupBy("doc_id").agg(F.min("position").alias("first"))
    whole = lines.select("doc_id", "position").join(begun, "doc_id")
    assess = lines.select("doc_id", F.col("position").alias("boundary"), F.least(F.lit(1.0), F.col("size") / 400).alias("confidence"), F.col("early").alias("split"))
    return S.refined(lines, whole, "doc_id", "position", _answers(lines), assess)
