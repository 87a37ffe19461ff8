import io
import zipfile

from pyspark.sql import functions as F


def test_chunks_cover_and_overlap():
    from inkwell.operators.kernels import text_chunks

    parts = text_chunks("\n".join(["a" * 900, "b" * 500, "c" * 300, "d" * 1600]), 1500, 200)
    assert [p["index"] for p in parts] == [1, 2, 3]
    assert parts[0]["text"] == "a" * 900 + "\n" + "b" * 500
    assert parts[1]["text"] == "b" * 500 + "\n" + "c" * 300 and parts[1]["start_char"] == parts[0]["end_char"] - 500
    assert parts[2]["text"] == "c" * 300 + "\n" + "d" * 1600
    assert text_chunks("", 1500, 200) == []


def test_chunks_equal_a_definition():
    import random

    import numpy as np

    from inkwell.operators.kernels import chunk_bounds

    choose = random.Random(8)
    for _ in range(300):
        sizes = [choose.randint(1, 40) for _ in range(choose.randint(0, 25))]
        size, overlap = choose.randint(10, 90), choose.choice([0, 5, 30])
        for k, (first, stop) in enumerate(bounds := chunk_bounds(np.array(sizes, np.int64), size, overlap)):
            least = bounds[k - 1][1] + 1 if k else first + 1
            length = lambda n, first=first: sum(sizes[first:n]) + n - first - 1
            ends = [n for n in range(least, len(sizes) + 1) if n == len(sizes) or length(n) + sizes[n] > size]
            assert stop == ends[0]
            if k + 1 < len(bounds):
                back = [f for f in range(first, stop + 1) if sum(sizes[f:stop]) >= overlap]
                assert bounds[k + 1][0] == max(back, default=first)


def test_units_keep_all_text_within_bounds():
    import re

    from inkwell.operators.kernels import narrative_units

    text = "\n\n".join(["x" * n for n in (900, 300, 50, 2400, 1200, 1100, 30)])
    units = narrative_units(text, 1500, 2500, 400, re.compile(r"^\*\*\*"))
    assert "".join(units).replace("\n", "") == text.replace("\n", "")
    assert all(len(u) <= 2500 + 4 for u in units)


def test_segments():
    from inkwell.operators.kernels import summary_segments

    assert summary_segments("aaaa. bbbb. cccc", 8) == ["aaaa.", "bbbb.", "cccc"]
    assert summary_segments("", 8) == []


def test_units_by_hand():
    import re

    from inkwell.operators.kernels import unit_numbers, without_tiny

    assert unit_numbers([5, 5, 5, 30, 4, 9, 2], [False] * 7, 10, 20) == [1, 1, 2, 3, 4, 4, 5]
    assert unit_numbers([12, 3, 3], [True, False, True], 10, 20) == [1, 1, 2]
    assert unit_numbers([15, 10], [True, False], 18, 20) == [1, 2]
    assert without_tiny(["a", "b", "c" * 9, "d", "e" * 20], 3, 12) == ["a\n\nb", "c" * 9 + "\n\nd", "e" * 20]
    assert without_tiny(["a", "c" * 12], 3, 12) == ["a", "c" * 12] and without_tiny([], 3, 12) == []
    from inkwell.operators.kernels import narrative_units

    assert narrative_units("One. Two! " + "x" * 12, 6, 10, 2, re.compile("^#")) == ["One.\n\nTwo!", "x" * 10, "xx"]


def test_tile(spark):
    from inkwell.operators.sequences import tiled

    windows = spark.createDataFrame([("a", list(range(1, 11))), ("b", [1, 3, 5])], "w string, orders array<int>")
    segments = spark.createDataFrame([("a", 3, 5), ("a", 4, 7), ("a", 5, 6), ("a", 20, 30)], "w string, first int, last int")
    got = sorted(tuple(r) for r in tiled(windows, segments, ["w"]).collect())
    assert got == [("a", 1, 2, True), ("a", 3, 5, False), ("a", 6, 7, False), ("a", 8, 10, True), ("b", 1, 5, True)]


def test_order_and_titles(spark):
    from inkwell.operators.kernels import order_ratio, title_similarity

    row = spark.createDataFrame([(["a", "b", "c", "d"], ["a", "c", "b", "x"], "abcd", "abxd")], "l array<string>, r array<string>, s string, t string").select(order_ratio("l", "r").alias("o"), title_similarity("s", "t").alias("t")).first()
    assert abs(row.o - 2 / 3) < 1e-12 and row.t == 0.75


def test_approximate_counts(spark):
    rows = spark.range(20_000).select((F.col("id") % 2_000).alias("v"))
    assert 1_900 < rows.agg(F.approx_count_distinct("v", 0.02)).first()[0] < 2_100


def test_shards_equal_a_loop(spark):
    from inkwell.operators.catalog import bounded_shards

    sizes = [400, 700, 300, 900, 100, 100, 2000, 5]
    got = bounded_shards(spark.createDataFrame([("g", i, n) for i, n in enumerate(sizes)], "g string, i long, size long"), "g", "i", "size", 3, 1200)
    assert [r.shard for r in got.orderBy("i").collect()] == [0, 0, 1, 1, 2, 2, 3, 4]


def test_components(spark):
    from inkwell.operators.graph import connected_components

    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (300, 200), (7, 7)] + [(1000, 1000 + i) for i in range(1, 400)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(51)} | {100: 100, 200: 100, 300: 100} | {1000 + i: 1000 for i in range(400)}


def test_suppression(spark):
    from inkwell.operators.patterns import suppressed

    rows = [("en", "a", 5, ["x", "y"]), ("en", "b", 9, ["x", "y"]), ("en", "c", 1, ["z"]), ("de", "a", 1, ["x", "y"])]
    got = {(r.lib, r.name): r.cluster for r in suppressed(spark.createDataFrame(rows, "lib string, name string, support long, terms array<string>"), "lib", "name", "support", "terms").collect()}
    assert got == {("en", "a"): "b", ("en", "b"): "b", ("en", "c"): "c", ("de", "a"): "a"}


def _epub(extra=()):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></container>')
        book.writestr("OPS/p.opf", '<package><manifest><item id="a" href="a.xhtml"/><item id="b" href="b.xhtml"/><item id="n" href="t.ncx" media-type="application/x-dtbncx+xml"/></manifest><spine><itemref idref="b"/><itemref idref="a"/></spine></package>')
        book.writestr("OPS/t.ncx", '<ncx><navMap><navPoint><navLabel><text>From contents</text></navLabel><content src="a.xhtml"/></navPoint></navMap></ncx>')
        book.writestr("OPS/a.xhtml", "<html><body><p>first</p></body></html>")
        book.writestr("OPS/b.xhtml", "<html><body><h1>Head</h1><p>second</p></body></html>")
        for name in extra:
            book.writestr(name, "x")
    return out.getvalue()


def test_books_and_archives(spark):
    from inkwell.sources.archives import archive_issues, books, members

    files = spark.createDataFrame([("good", bytearray(_epub())), ("locked", bytearray(_epub(["META-INF/encryption.xml"]))), ("bad", bytearray(b"no zip")), ("up", bytearray(_epub(["../x"])))], "path string, content binary")
    rows = [(r.path, r.order, r.title, r.text) for r in books(files.where("path in ('good', 'locked', 'bad')")).collect()]
    assert ("good", 1, "Head", "second") in rows and ("good", 2, "From contents", "first") in rows
    assert {r[0] for r in rows if r[1] is None} == {"locked", "bad"}
    assert {r.path: r.issues for r in archive_issues(members(files)).collect()} == {"good": [], "locked": [], "bad": ["broken"], "up": ["unsafe_path"]}


def test_texts(spark, tmp_path):
    from inkwell.sources.texts import decoded, discover, read_json_lines

    (tmp_path / "a.txt").write_bytes("章节".encode("gb18030"))
    (tmp_path / "b.txt").write_bytes("﻿plain".encode())
    (tmp_path / "c.bin").write_bytes(b"x")
    assert discover(spark, str(tmp_path)).count() == 2
    got = {r.text: r.encoding for r in decoded(spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(str(tmp_path))).collect()}
    assert got == {"章节": "gb18030", "plain": "utf-8"}
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    good, bad = read_json_lines(spark, str(tmp_path / "x.jsonl"), "a int")
    assert sorted(r.a for r in good.collect()) == [1, 2] and [r.value for r in bad.collect()] == ["not json"]


def test_streams(spark, tmp_path):
    from inkwell.streaming.events import newest_states, stable_counts

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = stable_counts(stream(), "ts", "event_type").writeStream.outputMode("append").format("memory").queryName("counts").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("counts").agg(F.sum("n")).first()[0] <= events.count()
    query = stream().writeStream.foreachBatch(newest_states("user_id", "event_id", str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.user_id, r.event_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(r.user_id, r.m) for r in events.groupBy("user_id").agg(F.max("event_id").alias("m")).collect()}


def test_few_texts_are_python_objects_at_a_time(spark):
    import tracemalloc

    import pyarrow as pa
    from inkwell.operators.kernels import segment_splitter, summary_segments

    texts = pa.array([f"{i}. " + "Some words here. " * 600 for i in range(1500)] + [None, ""])
    function = segment_splitter(1000).func
    tracemalloc.start()
    parts = function(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6e6 < texts.nbytes / 2
    assert parts[1499].as_py() == summary_segments(texts[1499].as_py(), 1000) and parts[1500].as_py() == parts[1501].as_py() == []
    assert len(function(pa.array([], pa.string()))) == 0
