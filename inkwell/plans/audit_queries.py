"""Queries for audit joins. Documents stand for the entries of their source's log, their ids for the time, their languages for the kinds of entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import audit as A
from inkwell.plans.registry import query, table


@query("""WITH e AS (SELECT source, doc_id AS time, lang FROM documents), d AS (SELECT source, time FROM e WHERE lang = 'en'), j AS (SELECT source, time FROM e WHERE lang = 'de'), s AS (SELECT source, time FROM e WHERE lang = 'fr'),
js AS (SELECT j.source, j.time, s.time AS entry_state FROM j ASOF LEFT JOIN s ON j.source = s.source AND j.time >= s.time), ds AS (SELECT d.source, d.time, s.time AS state_id FROM d ASOF LEFT JOIN s ON d.source = s.source AND d.time >= s.time)
SELECT ds.time AS id, js.time AS journal_id, state_id, CASE WHEN js.time IS NOT NULL AND entry_state IS NOT DISTINCT FROM state_id THEN 'verified' WHEN js.time IS NOT NULL THEN 'stale' WHEN state_id IS NOT NULL THEN 'reconstructed' ELSE 'none' END AS evidence
FROM ds ASOF LEFT JOIN js ON ds.source = js.source AND ds.time >= js.time""")
def deletion_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT10, CT9 in part: English entries as deletions, checked against the journal (German) and states (French) before them."""
    entries = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("time"), F.col("doc_id").alias("id"), "lang")
    of = lambda lang: entries.where(F.col("lang") == lang).drop("lang")
    return A.deletion_evidence(of("en"), of("de"), of("fr"), "source", "time").select("id", "journal_id", "state_id", "evidence")
