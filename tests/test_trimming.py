import pytest


def of(spark, rows, pack="LATIN_TRIM"):
    from inkwell.operators import trimming as T
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "i int, line string")
    got = frame.select("i", T.trimmed(F.col("line"), getattr(T, pack)).alias("t")).orderBy("i").collect()
    return [None if r.t is None else (r.t.action, r.t.cleaned, [(s.reason, s.text) for s in r.t.spans]) for r in got]


BODY = "He walked along the river, and she said nothing at all."


def test_latin_lines(spark):
    lines = [
        f"www.site.com ps: Please vote today! {BODY} (please vote for us) to be continued https://a.b/c", BODY, f"  {BODY}\t", "www.site.com short", "Chapter 12", "www.site.com Chapter 12 end of chapter", None, "",
        f"{BODY[:-1]}, subscribe now for more", "ps: " * 400 + BODY,
    ]
    got = of(spark, lines)
    assert got[0] == ("trim", BODY, [("url_prefix", "www.site.com"), ("ps_prefix", "ps:"), ("solicitation_prefix", "Please vote today!"), ("url_suffix", "https://a.b/c"), ("end_marker_suffix", "to be continued"), ("solicitation_parenthetical_suffix", "(please vote for us)")])
    assert got[1] == got[2] == ("keep", BODY, []) and got[3] == ("keep", "www.site.com short", [])
    assert got[4] == ("keep", "Chapter 12", []) and got[5] == ("trim", "Chapter 12", [("url_prefix", "www.site.com"), ("end_marker_suffix", "end of chapter")])
    assert got[6:8] == [None, ("keep", "", [])]
    assert got[8] == ("trim", f"{BODY[:-1]},", [("solicitation_suffix", ", subscribe now for more")])
    assert got[9][:2] == ("trim", BODY) and len(got[9][2]) == 400


def test_chinese_lines(spark):
    body = "他慢慢走到河边，什么也没有对她说。"
    got = of(spark, [f"天才一秒记住 www.abc.com {body}（求月票啊）（本章完）", f"求收藏，{body[:-1]}，求推荐票", "最新网址：abc 短句", "www.abc.com 第十二章 归来"], "CHINESE_TRIM")
    assert got[0] == ("trim", body, [("site_url_prefix", "天才一秒记住 www.abc.com"), ("end_marker_suffix", "（本章完）"), ("solicitation_parenthetical_suffix", "（求月票啊）")])
    assert got[1] == ("trim", f"{body[:-1]}，", [("solicitation_prefix", "求收藏，"), ("solicitation_suffix", "，求推荐票")])
    assert got[2][0] == "keep" and got[3] == ("trim", "第十二章 归来", [("url_prefix", "www.abc.com")])


@pytest.mark.parametrize(
    "pack, line, prose, frequency, dropped",
    [
        ("CHINESE_TRIM", "第3章 归来（3/3求订阅）", 0, 0, False), ("CHINESE_TRIM", "12章 求订阅", 0, 0, False), ("CHINESE_TRIM", "“这是一则广告，求月票。”", 2, 0, False), ("CHINESE_TRIM", "“请访问www.abc.com。”", 2, 0, True),
        ("CHINESE_TRIM", "街边贴满了广告，他看了一眼。", 3, 0, False), ("CHINESE_TRIM", "欢迎加入书友群12345678", 0, 0, True), ("CHINESE_TRIM", "ps：今天晚点更新", 0, 0, True), ("CHINESE_TRIM", "求月票", 0, 0, True),
        ("LATIN_TRIM", "accept all", 0, 1, True), ("LATIN_TRIM", "accept all", 0, 0, False), ("LATIN_TRIM", "Chapter 4 subscribe", 0, 0, False), ("LATIN_TRIM", "", 0, 0, False), ("LATIN_TRIM", None, 0, 0, False), ("LATIN_TRIM", "Read on at www.x.com", 4, 0, True),
    ],
)
def test_model_drops_are_guarded(spark, pack, line, prose, frequency, dropped):
    from inkwell.operators import trimming as T
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(line, prose, frequency)], "line string, prose int, frequency int")
    assert row.select(T.safe_drop(F.col("line"), F.col("prose"), F.col("frequency"), getattr(T, pack))).first()[0] is dropped


@pytest.mark.parametrize(
    "line, cleaned, kept",
    [(f"{BODY} vote for us", BODY, True), (f"{BODY} vote for us", f"{BODY} changed", False), (f"{BODY} and so on", BODY, False), (f"“{BODY}", BODY, False), (BODY, BODY, False), (f"{BODY} vote", "vote", False), (None, BODY, False), (BODY, None, False)],
)
def test_model_trims_are_guarded(spark, line, cleaned, kept):
    from inkwell.operators import trimming as T
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(line, cleaned)], "line string, cleaned string")
    assert row.select(T.safe_trim(F.col("line"), F.col("cleaned"))).first()[0] is kept
    say = T.guarded(F.lit("t"), F.col("line"), F.col("cleaned"), F.lit(0), F.lit(0))
    assert row.select(say).first()[0] == ("trim" if kept else "keep")


@pytest.mark.parametrize("name", ["trimmed_lines", "guarded_lines"])
def test_lines_are_split_once_and_never_joined(spark, name):
    from inkwell.plans import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1 and "Join" not in plan.split("Generate ")[0]


def test_signs_and_ends_equal_plain_counts(spark):
    """What is counted only as far as it takes, and ends that are cut without a pattern."""
    import re

    from inkwell.functions.text import normal_line
    from inkwell.operators import trimming as T
    from pyspark.sql import functions as F

    texts = ["a" * 16, "a" * 15, "1a-" * 16 + ".", "1a-" * 15 + "." * 90, " \t　\x0b x y 　\r\n", "", "　", "a  b\tc（d）", " a b ", "ä" * 16 + "!", "Chapter 1", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", T.bare(F.col("t")), normal_line(F.col("t")), T.safe_remainder(F.col("t"), T.LATIN_TRIM)).orderBy("i").collect()
    for _, bare, normal, safe in got[:-1]:
        text = texts[_]
        assert bare == re.sub(r"^[ \t\n\x0b\f\r　]+|[ \t\n\x0b\f\r　]+$", "", text)
        assert normal == " ".join(text.replace("（", "(").replace("）", ")").split())
        assert safe == (text == "Chapter 1" or (sum(x.isalpha() for x in text) >= 16 and len(text) >= 16 and any(x in text for x in ",.!?;")))
    assert list(got[-1])[1:] == [None, None, None]
