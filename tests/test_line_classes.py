import random
import re

import pytest

PIECES = [
    "Chapter 4", "chapter IV of it", "CHAPTER 4", "accept all", "Cookies here", "privacy settings", "www.a.com", "x www.b.org y", "https://a.b/c", "http://x", "all rights reserved", "click here", "a*** b", "c%%% d", "***", "%%% ",
    "licensed under MIT", "released under x", "a | b", "THIS IS A LONG SHOUT, YES", "-----", "please do vote", "thanks for your support", "!!", "@@", "$$$", "###", "vote", "follow", "“she” went", '"he"', "they thought it", "the door",
    "in the rain", "the wind and a window", "12 34", "é à ü", "(please share this) ", "end of chapter", "to be continued", "Subscribe now and go", "join our big group", "group 12345", "ps: hello", "A.COM", "SITE.Net", "Latest Chapter", "x", "..", " ", "\t", "aB3.x/y?z=1#", "",
    "He walked along the river and she said nothing at all that day.",
]


def texts(n):
    rng = random.Random(3)
    lines = lambda: [rng.choice(["", " ", "  "]) + " ".join(rng.choices(PIECES, k=rng.choice([1, 1, 2, 4]))) for _ in range(rng.randint(1, 25))]
    return [None, "", "\n\n", *["\n".join(x + rng.choices(x, k=12)) for x in (lines() for _ in range(n))]]


@pytest.mark.parametrize("name", ["line_noise", "cleaning_summary", "trimmed_lines", "guarded_lines"])
def test_noisy_lines_equal_sql(spark, tmp_path, name):
    import duckdb
    from inkwell.plans import ORACLE_SQL, QUERIES

    langs = ["en", "de", "es", "fr"]
    rows = [(i, t, langs[i % 4], f"s{i % 3}", len(t or "")) for i, t in enumerate(texts(60))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = db.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).select(*columns).collect()]
    want = want.fetchall()
    assert len(want) > 5 and sorted(map(repr, got)) == sorted(map(repr, want))


def test_matches_hold_their_literals(spark):
    from inkwell.operators.lines import has
    from inkwell.operators.trimming import LATIN_TRIM
    from pyspark.sql import functions as F

    pack = LATIN_TRIM.noise
    rows = spark.createDataFrame([(x,) for t in texts(40) if t for x in t.split("\n")], "line string")
    patterns = list(pack.literals)
    found = rows.select(*[F.count_if(has(F.col("line"), p, pack) != F.col("line").rlike(p)).alias(f"d{i}") for i, p in enumerate(patterns)], *[F.count_if(F.col("line").rlike(p)).alias(f"n{i}") for i, p in enumerate(patterns) if p != LATIN_TRIM.site]).first()
    assert not any(found[f"d{i}"] for i in range(len(patterns))) and all(v for k, v in found.asDict().items() if k[0] == "n")
    used = [*pack.strong, *pack.weak, pack.soft_meta, pack.boilerplate, *[p for p, _ in pack.prose], *[p for p, _ in LATIN_TRIM.suffixes], LATIN_TRIM.notice, LATIN_TRIM.meta, LATIN_TRIM.site]
    assert set(patterns) <= set(used)


@pytest.mark.parametrize("name", ["line_noise", "cleaning_summary"])
def test_no_line_is_shuffled_for_its_verdict(spark, name):
    from inkwell.plans import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and len(re.findall(r"\bExchange\b", plan)) == 1 and "Exchange" in plan.split("Generate ")[1]
