import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from .test_operators import brute_components

SF = "/root/testdata/sf0.001"


def masked(text, spans):
    """Spans (start, end) in order; one that begins inside what is masked already only lengthens it."""
    out, at = "", 0
    for start, end in spans:
        if not (start < at and at > 0):
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_stages_and_run(spark):
    """Each stage against a plain version over the rows that the one before it kept, and the whole run."""
    import corpus_pipeline
    from inkwell.llm.quality import perplexities
    from inkwell.llm.secrets import scan

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "packing"]
    quality, deduplicate, secrets, _ = (stage for _, stage in corpus_pipeline.STAGES)

    good = quality(spark, docs, SF).cache()
    assert good.columns == docs.columns
    judged = perplexities(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in judged.where("kept").collect()}

    single = deduplicate(spark, good, SF).cache()
    assert single.columns == docs.columns
    _, part = brute_components([(r.doc_id, r.text) for r in good.collect()], 5, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted(k for k, v in part.items() if k == v)

    safe = {r.doc_id: r for r in secrets(spark, single, SF).collect()}
    texts = {r.doc_id: r.text for r in single.collect()}
    for r in scan(single).collect():
        spans = [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x]
        assert safe[r.doc_id].text == masked(texts[r.doc_id], spans) and safe[r.doc_id].n_chars == len(safe[r.doc_id].text)
    assert safe.keys() == texts.keys()

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    want = Counter()
    for key, row in safe.items():
        ids = np.array(library.encode(row.text, add_special_tokens=False).ids + [0], "<u4")
        want.update((key, at // 2048, zlib.crc32(ids[at : at + 2048].tobytes())) for at in range(0, len(ids), 2048))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in rows) == want
    assert max(Counter(r.sequence_id for r in rows for _ in range(r.length)).values()) <= 2048


def test_repeated_ids(spark):
    """Different texts of one id are different documents; of equal rows and of near copies one stays, with the smallest id."""
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, b), (2, c), (2, c), (0, a + " end"), (3, ""), (3, ""), (4, None), (None, a), (None, a)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, `node.x` string")
    kept = corpus_pipeline.deduplicate(spark, docs, SF)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    assert found == Counter([(1, b), (2, c), (0, a + " end"), (3, ""), (3, ""), (4, None), (None, a), (None, a)])


def test_fewest_sequences():
    """The plan over counts opens as many sequences as best-fit over single pieces in falling order."""
    import random

    from inkwell.llm.packing import plan

    choose = random.Random(7)
    for _ in range(100):
        capacity = choose.choice([10, 32, 100])
        histogram = {n: choose.randint(1, 30) for n in choose.sample(range(1, capacity + 1), choose.randint(1, min(capacity, 10)))}
        free = []
        for length in sorted((n for n, count in histogram.items() for _ in range(count)), reverse=True):
            best = min((x for x in free if x >= length), default=None)
            if best is None:
                best = capacity
                free.append(best)
            free[free.index(best)] -= length
        assert len({sequence + k for _, _, count, sequence, _ in plan(histogram, capacity) for k in range(count)}) == len(free)
