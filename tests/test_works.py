import random
from itertools import combinations

import pytest

from .test_near_duplicates import prose


def plain_complete_link(links):
    """The plain loop: merge along the edges in order where every pair between the groups is an edge."""
    known = set(links)
    group = {node: {node} for link in links for node in link}
    for left, right in sorted(known):
        a, b = group[left], group[right]
        if a is not b and all(tuple(sorted((x, y))) in known for x in a for y in b):
            a |= b
            for node in b:
                group[node] = a
    return {node: min(nodes) for node, nodes in group.items()}


@pytest.mark.parametrize("most", [0, 12, 10_000])
def test_complete_link_equals_plain_loop(spark, most):
    from inkwell.operators.works import complete_link

    rng = random.Random(5)
    links = {tuple(sorted(rng.sample(range(part * 100, part * 100 + 9), 2))) for part in range(6) for _ in range(16)}
    links |= set(combinations(range(900, 906), 2)) | {(905, 950), (904, 950), (950, 960), (7_000, 7_001), (7_001, 7_002), (7_002, 7_003)}
    frame = spark.createDataFrame([*links, *list(links)[:5]], "left long, right long")
    got = {r.node: r.cluster for r in complete_link(frame, most).collect()}
    assert got == plain_complete_link(links)
    assert complete_link(frame.limit(0), most).collect() == []


def documents(spark, path, texts):
    """Texts with their title and author."""
    rows = [(i, text, author, title, len(text or "")) for i, (text, title, author) in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def catalogue(spark, path, **changed):
    """What the queries works and work_edges give, with other thresholds."""
    from inkwell.operators import fingerprint as P
    from inkwell.operators import works as W
    from inkwell.plans import dedup_queries as Q
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{path}/documents.parquet")
    members = Q._members(docs)
    relations = Q._relations(members, P.anchors(Q._head_texts(docs, members), "doc_id", "text"), P.Thresholds(**changed))
    return W.catalogue(members.select("id", "head", F.struct("chars").alias("quality")), relations.where("relation <> 'distinct'"), P.AUTOMATIC)


def test_chain_does_not_merge_what_differs(spark, tmp_path):
    rng = random.Random(9)
    a, c = prose(rng, 60), prose(rng, 60)
    path = documents(spark, tmp_path, [(". ".join(a), "t1", "x"), (". ".join(a + c), "t2", "y"), (". ".join(c), "t3", "z")])
    rows, edges = catalogue(spark, path, least_chars=100, version=(0.40, 0.85, 0.95, 5))
    works = {r.id: (r.work, r.action, r.version) for r in rows.collect()}
    assert works == {0: (0, "edition", 2), 1: (0, "canonical", 1), 2: (2, "canonical", 1)}
    assert {(r.left, r.right): (r.relation, r.automatic) for r in edges.collect()} == {(0, 1): ("same_work_version", True), (1, 2): ("transitive_conflict", False)}


def test_near_copy_is_an_edition(spark, tmp_path):
    rng = random.Random(10)
    body = prose(rng, 200)
    longer = [*prose(rng, 2), *body, *prose(rng, 12)]
    path = documents(spark, tmp_path, [(". ".join(body), "full", "x"), (". ".join(longer), "other", "x"), (". \n".join(body), "full", "x"), (None, None, None), ("", "e", "x")])
    rows, edges = catalogue(spark, path, least_chars=100)
    got = {r.id: (r.work, r.action, r.version) for r in rows.collect()}
    assert got == {0: (0, "edition", 2), 1: (0, "canonical", 1), 2: (0, "source_duplicate", 2), 4: (4, "canonical", 1)}
    assert [(r.left, r.right, r.relation) for r in edges.collect()] == [(0, 1, "same_work_version")]


@pytest.mark.parametrize(
    "titles, authors, relation",
    [(("t", "t"), ("x", "x"), "possible_incomplete"), (("t", "t"), ("x", None), "possible_incomplete"), (("t", "t"), ("x", "y"), "possible_same_work"), (("t", "u"), ("x", "x"), "possible_same_work"), ((None, None), ("x", "x"), "possible_same_work")],
)
def test_truncated_copy_needs_fitting_names(spark, tmp_path, titles, authors, relation):
    body = prose(random.Random(11), 170)
    path = documents(spark, tmp_path, [(". ".join(body), titles[0], authors[0]), (". ".join(body[:100]), titles[1], authors[1])])
    edges = catalogue(spark, path, least_chars=100)[1].collect()
    assert [(r.relation, r.automatic) for r in edges] == [(relation, relation == "possible_incomplete")]


def test_shuffled_copy_fails_on_order(spark, tmp_path):
    rng = random.Random(12)
    pieces = [prose(rng, 8) for _ in range(12)]
    mixed = pieces[::-1]
    path = documents(spark, tmp_path, [(". ".join(sum(pieces, [])), "t", "x"), (". ".join(sum(mixed, [])), "t", "x")])
    rows, edges = catalogue(spark, path, least_chars=100)
    assert len({r.work for r in rows.collect()}) == 2 and edges.collect() == []


def test_works_equal_plain_loop_on_table(spark):
    from inkwell.operators.fingerprint import AUTOMATIC
    from inkwell.plans import QUERIES

    sf = "/root/testdata/sf0.01"
    found = [tuple(r) for r in QUERIES["near_dup_relations"](spark, sf).select("left", "right", "relation").collect()]
    cluster = plain_complete_link([(a, b) for a, b, kind in found if kind in AUTOMATIC])
    heads = {r.id: r.head for r in QUERIES["near_dup_members"](spark, sf).collect()}
    assert {r.id: r.work for r in QUERIES["works"](spark, sf).select("id", "work").collect()} == {i: cluster.get(h, h) for i, h in heads.items()}
    edges = {(r.left, r.right): r.relation for r in QUERIES["work_edges"](spark, sf).collect()}
    assert edges == {(a, b): "transitive_conflict" if kind in AUTOMATIC and cluster[a] != cluster[b] else kind for a, b, kind in found if kind != "distinct"}


def test_long_sentences_give_blocks(spark):
    from inkwell.operators.fingerprint import sentence_blocks
    from pyspark.sql import functions as F

    long = "".join(chr(97 + i * 7 % 26) for i in range(500))
    rows = spark.createDataFrame([(f"** short one **. {long}!x",), ("",), (None,)], "text string")
    got = [r[0] for r in rows.select(sentence_blocks(F.col("text"))).collect()]
    assert got == [["shortone", *(long[at : at + 160] for at in range(0, 421, 80)), "x"], [""], None]
