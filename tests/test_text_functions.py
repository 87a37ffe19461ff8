from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.functions import text as T


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return frame.select(column.alias("x")).first().x


def test_normal_forms(spark):
    assert one(spark, T.normal_text(F.col("t")), t=" a\r\nb\r\rc\n\n\n\nd　") == "a\nb\n\nc\n\nd"
    assert one(spark, T.normal_line(F.col("t")), t="　（a）：  b ") == "(a): b"
    assert one(spark, T.canonical_url(F.col("t")), t="HTTP://User@Host.COM:80/a/b//?q=1#f") == "http://host.com/a/b"
    assert one(spark, T.canonical_url(F.col("t")), t="https://h.com") == "https://h.com/"
    assert one(spark, T.title_key(F.col("t")), t="12、《山海》(完本)") == "《山海》".strip("《》")
    assert one(spark, T.file_name(F.col("t")), t=' ..a/b:c?.. ') == "a_b_c_"
    assert one(spark, T.file_name(F.col("t")), t=" .. ") == "unknown_book"


def test_nulls(spark):
    assert one(spark, T.as_text(F.col("t")), t=None) == ""
    assert one(spark, T.as_bool(F.col("t")), t=None) is False
    assert one(spark, T.as_int(F.col("t")), t="x1") is None
    assert one(spark, T.normal_text(F.col("t")), t=None) is None


def test_numbers(spark):
    from inkwell.operators.headings import numeral

    for text, number in {"十二": 12, "三百零五": 305, "十万": 110_000, "一百万": 1_010_000, "两千零一": 2001, "42": 42, "一二三": 123, "二〇二四": 2024, "x": None, "": None}.items():
        assert one(spark, numeral(F.col("t")), t=text) == number, text


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="abc \n\t", max_size=20), st.text(alphabet="abc ", max_size=20))
def test_similarity_against_sets(spark, left, right):
    grams = lambda t: {t[i : i + 2] for i in range(len(t) - 1)}
    a, b = grams(left), grams(right)
    want = len(a & b) / len(a | b) if a | b else 0.0
    assert abs(one(spark, T.jaccard(T.char_grams(F.col("l"), 2), T.char_grams(F.col("r"), 2)), l=left, r=right) - want) < 1e-12
    assert one(spark, T.squeezed(F.col("l")), l=left, r=right) == " ".join(left.split())


def test_numerals_by_place_value(spark):
    import random

    from inkwell.operators import headings as H
    from pyspark.sql import functions as F

    rng = random.Random(1)
    texts = ["", "十", "一百零五", "二十万三千", "万", "三万万", "x二y十z", *("".join(rng.choices("零〇一二两九十百千万Oox3", k=rng.randint(1, 9))) for _ in range(500))]

    def plain(text, bare):
        total, parts = 0, text.split("万")
        for k, part in enumerate(parts):
            value = held = 0
            for sign in part:
                held = H.DIGITS.get(sign, held)
                if sign in H.UNITS:
                    value, held = value + (held or 1) * H.UNITS[sign], 0
            total += value + held if k == len(parts) - 1 else (value + (held or int(bare))) * 10_000
        return total

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for bare in (True, False):
        got = [r[1] for r in rows.select("i", H.unit_number(F.col("text"), bare)).orderBy("i").collect()]
        assert got == [plain(text, bare) for text in texts]
