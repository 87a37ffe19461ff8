import re
import unicodedata

import pytest

HAN = "第一章山河舊夢，他慢慢走到河邊。" * 20
SIMPLE = "第一章山河旧梦，他慢慢走到河边，说：“我们回去吧。”" * 20


def plain_score(text):
    """Sign by sign."""
    if not text:
        return -10.0
    n = len(text)
    han = sum("㐀" <= c <= "鿿" or "豈" <= c <= "﫿" for c in text)
    printable = sum(c.isprintable() or c in "\r\n\t" for c in text)
    controls = sum(unicodedata.category(c) == "Cc" and c not in "\r\n\t" for c in text)
    garbled = len(re.findall(r"(?:锟斤拷|烫烫烫|屯屯屯|�|Ã.|Â.|姝ｆ枃|绗\S|鍗\S)", text))
    return 0.55 * han / n + 0.45 * printable / n - 8 * text.count("�") / n - 5 * controls / n - min(0.5, 100 * garbled / n)


def decisions(spark, rows, size=64 * 1024):
    from inkwell.sources.encodings import file_encoding
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(i, None if row is None else bytearray(row)) for i, row in enumerate(rows)], "i int, content binary")
    got = frame.withColumn("d", file_encoding(F.col("content"), size)).orderBy("i").collect()
    return [(r.d.encoding, r.d.confidence) for r in got]


def test_marks_and_unicode(spark):
    rows = [b"\xef\xbb\xbfab", "﻿ab".encode("utf-16-le"), "﻿ab".encode("utf-16-be"), "﻿ab".encode("utf-32-le"), b"", None, HAN.encode(), b"plain"]
    want = ["utf-8-sig", "utf-16-le", "utf-16-be", "utf-32-le", "utf-8", None, "utf-8", "utf-8"]
    assert decisions(spark, rows) == [(name, name and "high") for name in want]


def test_scored_encodings(spark):
    got = decisions(spark, [SIMPLE.encode("gb18030"), HAN.encode("big5"), ("word " * 40 + HAN).encode("utf-16-le"), ("word " * 40 + HAN).encode("utf-16-be"), bytes(range(128, 256)) * 3])
    assert got[0] == ("gb18030", "high") and got[1][0] == "big5" and got[2][0] == "utf-16-le" and got[3][0] == "utf-16-be" and got[4][1] in ("ambiguous", "low", "high")


def test_samples_cut_signs(spark):
    """Windows that begin and end within a sign are still UTF-8; one bad byte in the middle is not."""
    text = ("ab" + "山" * 999).encode()
    for size in range(50, 56):
        assert decisions(spark, [text], size) == [("utf-8", "high")]
    assert decisions(spark, [text[:1498] + b"\xff" + text[1498:]], 200)[0][0] != "utf-8"


@pytest.mark.parametrize("text", [HAN, SIMPLE, "Ã©t\0é\x01 x\n", "�锟斤拷 ok", "𠀀 tab\t 豈"])
def test_score_equals_plain_count(text):
    from inkwell.sources.encodings import sample_score

    assert abs(sample_score(text) - plain_score(text)) < 1e-12


def test_bodies_and_whole_files(spark):
    from inkwell.sources.encodings import body_encoding, whole_encoding
    from pyspark.sql import functions as F

    meta = '<html><meta charset="big5"><p>'
    rows = [
        (SIMPLE.encode("gb18030"), "text/html; charset=GB18030", "gb18030", "gb18030"), ((meta + HAN).encode("big5"), "text/html", "big5", None), (HAN.encode(), "text/html; charset=nonsense", "utf-8", "utf-8"),
        (SIMPLE.encode("gb18030"), "text/html; charset=utf-8", "gb18030", "gb18030"), (None, "text/html", None, None), (b"", None, None, None), (HAN.encode("big5"), None, None, None),
    ]
    frame = spark.createDataFrame([(i, None if raw is None else bytearray(raw), header) for i, (raw, header, *_) in enumerate(rows)], "i int, content binary, header string")
    got = frame.select("i", body_encoding(F.col("content"), F.col("header")).alias("body"), whole_encoding("content").alias("whole")).orderBy("i").collect()
    for r, (raw, _, body, whole) in zip(got, rows, strict=True):
        assert raw is not None or (r.body, r.whole) == (None, None)
        assert body is None or r.body == body
        assert whole is None or r.whole == whole


def test_documents_come_back(spark):
    from inkwell.plans import QUERIES

    rows = QUERIES["encoding_decisions"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 * 5
    for r in rows:
        if r.used in ("utf-8", "utf-8-sig"):
            assert (r.encoding, r.confidence) == (r.used, "high")
        else:  # wrong only where the margin says so, or where a text is too short to tell
            assert r.encoding == r.used or r.confidence != "high" or r.encoding == "utf-8" or r.used == "utf-16-le", r
    right = sum(r.encoding == r.used for r in rows)
    assert right >= 0.9 * len(rows), right
