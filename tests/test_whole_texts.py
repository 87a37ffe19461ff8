import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, path):
    """Equal openings of over 300 characters, ends that differ, a text without words, an empty one and a null one."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh\u00e9\U0001f600", k=rng.randint(5, 9))) for _ in range(60)]
    opening = " ".join(rng.choices(words, k=80))
    rows = [(i, f"{opening} {' '.join(rng.choices(words, k=rng.randint(0, 60)))}", rng.choice(("en", "de")), f"s{i % 3}") for i in range(120)]
    rows += [(150, "ab", "en", "s0"), (151, "", "en", "s0"), (200, None, "en", "s0")]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).write.parquet(str(path / "documents.parquet"))
    return rows


def terms(text):
    return {w for w in re.split("[^a-z]+", (text or "").lower()) if len(w) >= 7}


def test_gram_similarity_takes_whole_texts(spark, tmp_path):
    from inkwell.plans import QUERIES

    grams = {i: {t.lower()[k : k + 3] for k in range(len(t) - 2)} for i, t, _, _ in documents(spark, tmp_path) if t is not None}
    both = {i: (g, grams[i + 1]) for i, g in grams.items() if i + 1 in grams}
    want = {i: (len(g), round(len(g & h) / len(g | h), 9) if g | h else 0.0) for i, (g, h) in both.items()}
    got = {r.doc_id: (r.n_grams, round(r.jaccard, 9)) for r in QUERIES["gram_similarity"](spark, str(tmp_path)).collect()}
    assert got == want


def test_shortlist_searches_whole_texts(spark, tmp_path):
    from inkwell.plans import QUERIES

    rows = documents(spark, tmp_path)
    want = {}
    for i, text, lang, _ in rows:
        near = [(-len(terms(text) & terms(t)) / len(terms(text) | terms(t)), j) for j, t, other, _ in rows if i % 50 == 0 and j != i and other == lang and terms(text) & terms(t)]
        want |= {(lang, i, j): round(-score, 9) for score, j in sorted(near)[:6]}
    got = {(r.lang, r.left, r.right): round(r.jaccard, 9) for r in QUERIES["shortlist"](spark, str(tmp_path)).collect()}
    assert want and got == want


def test_divergence_takes_whole_texts(spark, tmp_path):
    from inkwell.plans import QUERIES

    rows, want = documents(spark, tmp_path), {}
    for source in ("s0", "s1", "s2"):
        own = [terms(t) for _, t, _, s in rows if s == source]
        pairs = [(a, b) for k, a in enumerate(own) for b in own[:k]]
        want[source] = round(1 - sum(bool(a & b) and len(a & b) / len(a | b) >= 0.08 for a, b in pairs) / len(pairs), 9)
    assert {r.source: round(r.apart, 9) for r in QUERIES["divergence"](spark, str(tmp_path)).collect()} == want
