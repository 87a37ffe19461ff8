import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from .conftest import ROWS


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))


def test_bpe_equals_library(docs, no_docs):
    from inkwell.llm.bpe import encode_documents

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = sorted(map(tuple, encode_documents(docs, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded").toPandas().fillna(-1).values.tolist()), key=str)
    want = []
    for key, text, _ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out = library.decode(ids, skip_special_tokens=False)
        want.append((float(-1 if key is None else key), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(out.encode()).hexdigest(), out))
    assert got == sorted(want, key=str)
    assert encode_documents(no_docs, path).count() == 0


def test_bpe_fuzz():
    from inkwell.llm.bpe import Encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), Encoder(open(path, encoding="utf-8").read())
    choose = random.Random(5)
    signs = [*"aab  \n\t'sst reve don''ll1234é漢字😀!?.,-_== \u0085\x1c\x1fſ՘", "<|endoftext|>", " the", "  "]
    for _ in range(2000):
        text = "".join(choose.choice(signs) for _ in range(choose.randint(0, 40)))
        ids, decimals = encoder.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and decimals == ",".join(map(str, want)), text
        assert encoder.decode_bytes(ids).decode() == library.decode(want, skip_special_tokens=False)
    long = "ab" * 50_000
    assert encoder.encode(long)[0].tolist() == library.encode(long, add_special_tokens=False).ids


def test_licenses(docs, no_docs):
    from inkwell.llm.licenses import PHRASES, scan

    got = sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in scan(docs).collect())
    want = []
    for key, text, _ in ROWS:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))
        places, labels = [], set()
        for phrase, label in PHRASES.items():
            parts = phrase.split()
            for i in range(len(words) - len(parts) + 1):
                if words[i : i + len(parts)] == parts:
                    places.append(i)
                    labels.add(label)
        want.append(str((key, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))))
    assert got == sorted(want)
    assert scan(no_docs).count() == 0


def test_license_notice_with_changes(spark):
    from inkwell.llm.licenses import NOTICES, scan

    words = NOTICES["mit-text"].split()
    words[5:5] = ["really", "quite"]
    del words[20]
    row = scan(spark.createDataFrame([(1, "Foo. " + " ".join(words).upper() + " bar")], "doc_id long, text string")).first()
    assert row.labels == "mit-text" and 0.5 < row.score < 1


def vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (2, [0.99, 0.05, 0.0, 0.0]), (3, [0.0, 1.0, 0.0, 0.0]), (4, [1.0, 0.0, 0.0, 0.0]), (5, None), (6, [0.0] * 4), (7, [float("nan"), 1.0, 0.0, 0.0]), (8, [None, 1.0, 0.0, 0.0]), (9, []), (None, [1.0, 0.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0, 0.0]), (10, [1.0, 0.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_vectors_edges(spark):
    from inkwell.llm.vectors import near_duplicates

    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicates(vectors(spark)).collect()}
    assert {(1, 2, 1, True), (2, 2, 1, False), (4, 2, 1, False), (3, 0, 3, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True), (None, 0, None, False)} == got
    assert near_duplicates(vectors(spark).limit(0)).count() == 0


def test_vectors_recall(spark):
    from inkwell.llm.vectors import near_duplicates

    random_rows = np.random.default_rng(3)
    base = random_rows.normal(size=(300, 32))
    rows = np.concatenate([base, base[:100] + 0.08 * random_rows.normal(size=(100, 32)), base[:1] + 0.05 * random_rows.normal(size=(60, 32))]).astype(np.float32)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id long, embedding array<float>")
    got = np.array([r.n_links for r in near_duplicates(frame).orderBy("vec_id").collect()])
    assert (got <= links).all() and got.sum() >= 0.9 * links.sum()


def test_packing(docs, no_docs):
    from inkwell.llm.packing import pack

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = pack(docs, path, capacity=64).collect()
    want = Counter()
    for key, text, _ in ROWS:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.update((key, at // 64, at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes())) for at in range(0, len(ids), 64))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert pack(no_docs, path).count() == 0


def test_plan_is_gapless():
    from inkwell.llm.packing import plan

    choose = random.Random(1)
    for _ in range(200):
        capacity = choose.choice([5, 16, 64])
        histogram = {n: choose.randint(1, 40) for n in choose.sample(range(1, capacity + 1), choose.randint(1, min(capacity, 12)))}
        filled = {}
        for length, first, count, sequence, offset in plan(histogram, capacity):
            for k in range(count):
                filled.setdefault(sequence + k, []).append((offset, length))
        assert Counter(n for places in filled.values() for _, n in places) == histogram
        for places in filled.values():
            ends = 0
            for offset, length in sorted(places):
                assert offset == ends
                ends += length
            assert ends <= capacity


def test_quality(spark, docs, no_docs):
    from inkwell.llm.quality import filter_quality, perplexities

    choose = random.Random(2)
    clean = lambda: " ".join(choose.choice(["the", "cat", "sat", "on", "a", "mat", "and", "dog"]) for _ in range(60))
    junk = lambda: " ".join("".join(choose.choice("qxzvw%$#") for _ in range(6)) for _ in range(60))
    rows = [(i, clean() if i % 5 else junk(), "en") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in perplexities(frame, labels).collect() if r.kept}
    assert kept == {i for i in range(300) if i % 5}
    assert filter_quality(frame, labels).columns == frame.columns
    assert filter_quality(docs.withColumn("a.b", docs["lang"]), labels.limit(0)).count() == len(ROWS)
    assert filter_quality(no_docs, labels).count() == 0


def test_kneser_ney_sums_to_one(spark):
    from inkwell.llm.minhash import word_hashes
    from inkwell.llm.quality import fit

    text = "a b a b a c b a d a b c a b a"
    model = fit(spark.createDataFrame([(text,), (text[::-1],)], "text string"))
    for before in ("a b", "c b", "d d"):
        total = sum(10 ** model.log_probabilities(word_hashes(f"{before} {w}".encode()))[-1] for w in "abcd")
        unknown = 10 ** model.log_probabilities(word_hashes(f"{before} zzz".encode()))[-1]
        assert abs(total + unknown - 1) < 1e-9


def plain_kneser_ney(texts):
    """log10 of a text's probability, from dictionaries of counts."""
    from inkwell.llm.quality import discounts

    padded = lambda text: [None, None, *(w.encode().lower() for w in text.split())]
    three = Counter(tuple(p[k : k + 3]) for p in map(padded, texts) for k in range(len(p) - 2))
    two = Counter(key[1:] for key in three)
    one = Counter(key[1:] for key in two)
    off, left, total = [], [], []
    for counts in (one, two, three):
        d = (0, *discounts(Counter(min(n, 5) for n in counts.values())))
        rest, sums = Counter(), Counter()
        for key, n in counts.items():
            rest[key[:-1]] += d[min(n, 3)]
            sums[key[:-1]] += n
        off.append(d), left.append(rest), total.append(sums)

    def probability(key):
        if not key:
            return left[0][()] / total[0][()] / (len(one) + 1)
        k, before = len(key) - 1, key[:-1]
        n, lower = (one, two, three)[k][key], probability(key[1:])
        if k == 0:
            return (n - off[0][min(n, 3)]) / total[0][()] + lower
        return (n - off[k][min(n, 3)] + left[k][before] * lower) / total[k][before] if total[k][before] else lower

    return lambda text: sum(math.log10(probability(tuple(p[k : k + 3]))) for p in [padded(text)] for k in range(len(p) - 2))


def test_quality_is_fitted_on_all_trusted_texts(spark, monkeypatch):
    """More than 2,500 trusted texts, and one of more than 20,000 characters; few words and all of them known to all workers."""
    from inkwell.llm import quality

    choose = random.Random(4)
    words = [f"w{k}" for k in range(40)]
    texts = {i: " ".join(choose.choice(words[: choose.randint(2, 40)]) for _ in range(choose.randint(1, 12))) for i in range(3_200)}
    texts[3_200] = texts[3_201] = " ".join(f"long{k % 900}" for k in range(3_500))
    texts |= {3_202: "long1 long2 long3 w1 w2", 3_203: "never seen w0 w0 w1", 3_204: "w1", 3_205: " ", 3_206: texts[3_200]}
    frame = spark.createDataFrame([(i, t, "en") for i, t in texts.items()] + [(None, None, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3_202)], "doc_id long, quality int, toxic int")
    fitted = [r.doc_id for r in quality.trusted_ids(labels, False).collect()]
    assert len(fitted) > 2_500 and {3_200, 3_201} & set(fitted)
    plain = plain_kneser_ney([texts[i] for i in fitted])
    want = {i: plain(t) for i, t in texts.items()}
    for frequent, together in ((200_000, 1 << 19), (8, 500)):
        monkeypatch.setattr(quality, "FREQUENT", frequent)
        monkeypatch.setattr(quality, "TOGETHER", together)
        rows = {r.doc_id: r for r in quality.perplexities(frame, labels).collect()}
        assert rows.keys() == want.keys() | {None}
        assert all(rows[i].n_words == len(t.split()) and abs(rows[i].log10_prob - want[i]) < 1e-6 for i, t in texts.items())
        assert rows[3_200].log10_prob == rows[3_201].log10_prob == rows[3_206].log10_prob


def test_quality_shards_answer_in_few_rows_and_short_ones(spark, monkeypatch):
    """Rows of answers don't grow with texts times shards, and trigrams of frequent words take few bytes."""
    from inkwell.llm import quality

    choose = random.Random(6)
    texts = [" ".join(choose.choice([f"w{k}" for k in range(300)]) for _ in range(60)) for _ in range(400)]
    frame = spark.createDataFrame(enumerate(texts), "key long, text string").coalesce(2)
    monkeypatch.setattr(quality, "SHARD", 4_000)
    model = quality.fit(frame.select("text"))
    answers = sum(model._turn(frame, turn, False).count() for turn in range(quality.TURNS))
    assert model.shards >= 60 and answers <= 3 * 2 * model.shards  # two groups of texts, three kinds of rows
    columns = [c for c in model.trigrams.columns if c not in ("shard", "kind", "group")]
    size = sum(len(row[c] or b"") for row in model.trigrams.collect() for c in columns)
    trigrams = {tuple(p[k : k + 3]) for t in texts for p in [[None, None, *t.split()]] for k in range(len(p) - 2)}
    assert size < 14 * len(trigrams)


def test_hashes_of_many_texts():
    from inkwell.llm.minhash import word_hashes
    from inkwell.llm.quality import hashes_of

    choose = random.Random(7)
    parts = ["a", "A", "b\0", "b", "\0", "h\u00e9", "\u4e2d\u6587", "word" * 3, "eightchr", "sixteen characte", "x" * 64, "x" * 65, "y" * 300, " ", "\t", "\r\n", "\x0b\x0c", "\x1c", "\x85", "\u00a0"]
    texts = [b"", b" ", *("".join(choose.choice(parts) + choose.choice(["", " "]) for _ in range(choose.randint(0, 30))).encode() for _ in range(300)), b"\n"]
    for _ in range(2):  # the second time from memory
        hashes, many = hashes_of(texts)
        want = [word_hashes(t) for t in texts]
        assert many.tolist() == [len(w) for w in want] and (hashes == np.concatenate(want)).all()
    assert hashes_of([b""])[1].tolist() == [0]


def test_known_hashes_are_found_in_few_steps():
    """Values of keys that are there, not there, beyond all others or crowded; and faster than a binary search of all."""
    from inkwell.llm.quality import Known

    choose = np.random.default_rng(8)
    for bits in (48, 64):
        top = (1 << bits) - 1
        spread = choose.integers(0, top, 5_000, np.uint64)
        crowded = np.uint64(top // 3) + np.arange(300, dtype=np.uint64)
        for hashes in (spread[:0], spread[:1], np.unique(spread), np.unique(np.concatenate([spread[:40], crowded])), np.array([0, 1, top - 1, top], np.uint64)):
            values = choose.random(len(hashes))
            keys = np.concatenate([hashes, spread, hashes + np.uint64(1) if len(hashes) < 4 else crowded, np.array([0, top], np.uint64)]) & np.uint64(top)
            want = dict(zip(hashes.tolist(), values.tolist(), strict=True))
            assert Known(hashes, values, bits).find(keys, 9.0).tolist() == [want.get(k, 9.0) for k in keys.tolist()]

    hashes = np.unique(choose.integers(0, (1 << 64) - 1, 1 << 18, np.uint64))
    keys = choose.permutation(np.append(hashes, choose.integers(0, (1 << 64) - 1, 1 << 18, np.uint64)))
    known = Known(hashes, np.arange(len(hashes)))

    def seconds(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    assert min(seconds(lambda: known.find(keys)) for _ in range(5)) < min(seconds(lambda: np.searchsorted(hashes, keys)) for _ in range(5))


def test_distinct_hashes():
    from inkwell.llm.quality import _distinct

    choose = np.random.default_rng(9)
    few = choose.integers(0, (1 << 64) - 1, 50, np.uint64)
    for x in (few[:0], few[:1], few, choose.choice(few, 3_000), choose.choice(np.append(few, few ^ np.uint64(1)), 3_000), choose.integers(0, 40, 3_000, np.uint64)):
        found, first, inverse = _distinct(x)
        assert (found == np.unique(x)).all() and (x[first] == found).all() and (found[inverse] == x).all()


def test_trigrams_are_read_as_they_were_dealt():
    """Rows of several shards together, with words that have codes and words that don't."""
    from inkwell.llm.quality import _bunches, Codes, Dealt

    choose = np.random.default_rng(10)
    words = choose.integers(0, 1 << 48, 400, np.uint64)
    many = choose.integers(0, 30, 200)
    codes = Codes(words[:150])
    dealt = Dealt(choose.choice(words, many.sum()), many, codes, 7)
    rows = [(at, blobs) for _, at, blobs in dealt.blobs(np.arange(many.sum()))]
    assert len(rows) == 7
    places = np.concatenate([at for at, _ in rows])
    assert sorted(places.tolist()) == list(range(many.sum()))
    for have, want in zip(codes.read([blobs for _, blobs in rows]), (dealt.two, dealt.before, dealt.word), strict=True):
        assert (have == want[places]).all()
    rows = [(k, b"xx" * choose.integers(1, 40_000)) for k in range(500)] + [(500 + k, b"xx") for k in range(500)]
    bunches = list(_bunches(iter(rows)))
    assert sum(bunches, []) == rows and max(map(len, bunches)) <= 64
    assert all(sum(len(row[-1]) // 2 for row in bunch[:-1]) < 1 << 17 for bunch in bunches)


def test_hmm(docs, no_docs, monkeypatch):
    from inkwell.llm import hmm

    held = lambda key: key is None or zlib.crc32(str(key).encode()) % 10 == 0
    tokens = lambda text: [*spaced_words(text), None]
    counts = Counter(t for key, text, _ in ROWS if not held(key) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(
        str((key, held(key), len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), total, round(sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens(text)), 6)))
        for key, text, _ in ROWS
    )
    for frequent, symbols in ((200_000, 4_096), (8, 4)):
        monkeypatch.setattr(hmm, "FREQUENT", frequent)
        monkeypatch.setattr(hmm, "SYMBOLS", symbols)
        rows = hmm.score(docs).collect()
        assert sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in rows) == want
        assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert hmm.score(no_docs).count() == 0


def test_forward_is_exact():
    from inkwell.llm.hmm import Lanes, Model

    model = Model.first(np.array([5.0, 3, 2, 1]), 3)
    sequences = [np.array([0, 1, 2, 3, 3, 1]), np.array([2]), np.array([1, 1, 1])]
    logs, _, _ = Lanes(sequences).forward(model, np.broadcast_to(model.start, (3, 3)), False)
    for codes, log in zip(sequences, logs, strict=True):
        total = 0.0
        for states in product(range(3), repeat=len(codes)):
            p = model.start[states[0]] * model.emit[states[0], codes[0]]
            for k in range(1, len(codes)):
                p *= model.move[states[k - 1], states[k]] * model.emit[states[k], codes[k]]
            total += p
        assert abs(math.log10(total) - log) < 1e-9


def test_stretches_are_exact(monkeypatch):
    """Cut in short stretches, texts have the same probabilities and expected counts as whole ones."""
    from inkwell.llm import hmm

    model = hmm.Model.first(np.array([5.0, 3, 2, 1]), 3)
    choose = np.random.default_rng(2)
    texts = [choose.integers(0, 4, n) for n in (1, 7, 23, 4, 12, 40)]
    whole = hmm.Stretches(model, texts)
    want, logs = whole.expected(), whole.scores().copy()
    assert abs(want[3] - logs.sum()) < 1e-9
    monkeypatch.setattr(hmm, "STRETCH", 4)
    cut = hmm.Stretches(model, texts)
    for a, b in zip(cut.expected()[:3], want[:3], strict=True):
        assert np.allclose(a, b, atol=1e-9)
    assert np.allclose(cut.scores(), logs, atol=1e-9)


def brute_expected(model, texts):
    """Expected counts by listing all paths of states, and the likelihood."""
    states, symbols = model.emit.shape
    starts, moves, emits, likelihood = np.zeros(states), np.zeros((states, states)), np.zeros((states, symbols)), 0.0
    for codes in texts:
        paths = {}
        for path in product(range(states), repeat=len(codes)):
            p = model.start[path[0]] * math.prod(model.emit[s, c] for s, c in zip(path, codes, strict=True))
            paths[path] = p * math.prod(model.move[a, b] for a, b in zip(path, path[1:], strict=False))
        total = sum(paths.values())
        likelihood += math.log10(total)
        for path, p in paths.items():
            starts[path[0]] += p / total
            for s, c in zip(path, codes, strict=True):
                emits[s, c] += p / total
            for a, b in zip(path, path[1:], strict=False):
                moves[a, b] += p / total
    return starts, moves, emits, likelihood


def test_score_end_to_end(spark, monkeypatch):
    """Scores equal a plain version that trains and scores by listing all paths."""
    from inkwell.llm import hmm

    for name, value in (("STATES", 2), ("SYMBOLS", 3), ("FREQUENT", 4), ("ROUNDS", 2), ("STRETCH", 2), ("RISE", -math.inf)):
        monkeypatch.setattr(hmm, name, value)
    monkeypatch.setattr(hmm.math, "isqrt", lambda n: 0)
    choose = random.Random(3)
    rows = [(i, " ".join(choose.choice(["a", "a", "b", "b", "c", "d", "e"]) for _ in range(choose.randint(0, 6)))) for i in range(30)]
    tokens = {i: [*text.encode().split(), b" "] for i, text in rows}
    trained = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(t for i in trained for t in tokens[i])
    # The most frequent words by whole steps of counts, FREQUENT at most; the first of them are symbols.
    steps = Counter(math.floor(math.log2(c) * 16) for c in counts.values())
    held, least = 0, None
    for step in sorted(steps, reverse=True):
        if held + steps[step] > 4:
            break
        held, least = held + steps[step], step
    words = sorted((w for w, c in counts.items() if math.floor(math.log2(c) * 16) >= least), key=lambda w: (-counts[w], w))
    symbol = {w: i for i, w in enumerate(words[:3])}
    total, distinct, n = sum(counts.values()), len(counts), len(symbol)
    rest = total - sum(counts[w] for w in symbol)
    symbol_counts = np.array([*(counts[w] for w in symbol), rest], float)
    share = (symbol_counts + 0.1) / (symbol_counts + 0.1).sum()
    codes = {i: [symbol.get(t, n) for t in tokens[i]] for i in tokens}
    model = hmm.Model.first(symbol_counts, 2)
    for _ in range(2):
        start, move, emit, _ = brute_expected(model, [codes[i] for i in trained])
        model = hmm.Model.from_counts(start, move, emit, share)
    got = {r.doc_id: r.score for r in hmm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in tokens:
        inside = sum(math.log10((counts[t] + 0.1) / (rest + 0.1 * (distinct - n + 1))) for t in tokens[i] if t not in symbol)
        assert abs(got[i] - brute_expected(model, [codes[i]])[3] - inside) < 1e-9


def test_many_words_of_one_count(spark, monkeypatch):
    from inkwell.llm import hmm

    monkeypatch.setattr(hmm, "FREQUENT", 10)
    words, counts = hmm.frequent_words(spark.createDataFrame([(f"w{i}".encode(), 3) for i in range(200)], "word binary, c long"))
    assert 0 < len(words) < 40 and set(counts) == {3}


def test_baum_welch_never_falls():
    from inkwell.llm.hmm import Lanes, Model

    choose = np.random.default_rng(1)
    sequences = [choose.integers(0, 6, n) for n in (30, 5, 17, 1)]
    model, last = Model.first(np.ones(6), 3), -math.inf
    for _ in range(8):
        start, move, emit, log = Lanes(sequences).expected(model, np.broadcast_to(model.start, (4, 3)), np.ones(4, bool))
        assert abs(emit.sum() - 53) < 1e-9 and abs(start.sum() - 4) < 1e-9 and abs(move.sum() - 49) < 1e-9
        assert log >= last - 1e-9
        model, last = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)), log


def test_secrets(docs, no_docs):
    from inkwell.llm.secrets import KINDS, redact, scan

    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = []
    for key, text, _ in ROWS:
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
        want.append(str((key, hashlib.sha256(joined.encode()).hexdigest())))
    assert sorted(str((r.doc_id, r.base_sha256)) for r in scan(docs).collect()) == sorted(want)
    for name in ("row", "clean", "assign", "access", "hex", "runs", "entropy", "spans", "__text", "a.b"):
        docs = docs.withColumn(name, docs["lang"])
    masked = redact(docs)
    assert masked.columns == docs.columns
    assert [r.text for r in masked.where("doc_id = 8").collect()] == ['[SECRET]" [SECRET] [SECRET] token:short']
    assert scan(no_docs).count() == 0


def test_secret_entropy(spark):
    from inkwell.llm.secrets import scan

    rows = [(1, "see a9Zk3LmQ7xT2bV8nR4wY6 here"), (2, "a" * 30 + "1"), (3, "550e8400-e29b-41d4-a716-446655440000"), (4, "thisisjustaverylongwordwithoutdigits")]
    found = {r.doc_id: r.n_entropy for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 1, 2: 0, 3: 0, 4: 0}


PAGES = [
    ("<html><head><title>T</title></head><body><nav><a>menu</a></nav><article><h1>Head &amp; line</h1><p>One  two <b>three</b></p><script>var a='</p>'</script><p>four</p></article><footer>foot words are here</footer></body></html>", "Head & line\n\nOne two three\n\nfour"),
    ("<body><header>Site name here</header><div class='content'><p>One two three four five six</p><ul><li>a<li>b</ul><div class='ad'>buy now</div><form><p>sign up now</p></form></div><div id='comments'><p>I think this comment is far longer than the text is</p></div>", "One two three four five six\n\na\n\nb"),
    (None, ""), ("", ""), ("<p", ""), ("<div>hello world<!-- cut", "hello world"), ("plain text only", "plain text only"),
    ('<p title="x>bar baz</p><p>more words</p>', "bar baz\n\nmore words"),
    ("<p data=it's>one two</p><p>don't <b class='a>b'>stop</b></p>", "one two\n\ndon't stop"),
    ("<!--><p>after a short comment</p><!---><p>and another</p><!-- x --!><p>third</p>", "after a short comment\n\nand another\n\nthird"),
    ("<article><p>one two three</p><div class='related-work'><p>kept words here</p></div><div class='related-posts'><p>dropped</p></div></article>", "one two three\n\nkept words here"),
]


def test_html(spark):
    from inkwell.llm.html import extract

    frame = spark.createDataFrame([(i, f"http://x/{i}", html, "x") for i, (html, _) in enumerate(PAGES)] + [(None, None, "<p>no id</p>", "x")], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in extract(frame).collect()}
    assert got == {i: (text, len(text)) for i, (_, text) in enumerate(PAGES)} | {None: ("no id", 5)}
    assert extract(frame.limit(0)).count() == 0


def test_html_depth():
    """Deep and unclosed nesting costs no more than its length."""
    from inkwell.llm.html import label_counts, main_text

    page = "<div>word " * 60_000
    assert main_text(page, {}).count("word") == 60_000 or main_text(page, {}) == "word"
    assert label_counts("<article>" + page)["in div", True] == 60_000 * 60_001 // 2


def test_html_label_counts_by_paths():
    from inkwell.llm.html import Page, label_counts

    source = "<div class=a><p>one two</p><article><div class=b><p>three</p><article><p>x y z</p></article></div></article><section><p>four five</p></section></div><nav>m</nav>"
    page, want = Page(source, {}), Counter()
    for text, tags, holder in zip(page.blocks, page.features, page.holders, strict=True):
        path = [holder]
        while path[0]:
            path.insert(0, page.parents[path[0]])
        article = next((k for k, i in enumerate(path) if page.names[i] == "article"), None)
        for tag, n in tags.items():
            want[tag, article is not None] += n
        for i in path[0 if article is None else article + 1 :]:
            for key in page.keys[i]:
                want[f"in {key}", article is not None] += text.count(" ") + 1
    assert +label_counts(source) == want


def test_media(spark, docs, no_docs):
    from inkwell.llm.media import payload_of, read_media, round_trip, store_media
    from inkwell.session import fresh_path

    got = sorted(str((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32)) for r in round_trip(docs).collect())
    payload = lambda text: payload_of(text)
    want = sorted(str((key, len((text or "").encode()), len(payload(text)), hashlib.sha256(payload(text)).hexdigest(), zlib.crc32(payload(text)[-64:]))) for key, text, _ in ROWS)
    assert got == want
    assert round_trip(no_docs).count() == 0
    path = fresh_path(spark, "media")
    assert store_media(docs, path)["members"] == len(ROWS)
    assert read_media(spark, path, rangeBytes="1024").count() == len(ROWS)


def test_media_features_by_definition(docs):
    from inkwell.llm.media import decode_image, encode_image, payload_of, round_trip

    want = {}
    for _, text, _ in ROWS:
        payload = payload_of(text)
        image = encode_image(payload)
        assert decode_image(image) == payload
        shares = [n / len(payload) for n in Counter(payload).values()]
        mean = sum(payload) / len(payload)
        deviation = math.sqrt(sum((x - mean) ** 2 for x in payload) / len(payload))
        step = sum(abs(a - b) for a, b in zip(payload, payload[1:], strict=False)) / (len(payload) - 1)
        feature = f"h={len(payload) // 64};mean={mean:.4f};dev={deviation:.4f};bits={-sum(p * math.log2(p) for p in shares):.4f};step={step:.4f}"
        want[hashlib.sha256(payload).hexdigest()] = (len(image), hashlib.sha256(image).hexdigest(), feature)
    for r in round_trip(docs).collect():
        assert (r.media_bytes, r.media_sha256, r.feature.replace("bits=-0.0", "bits=0.0")) == (*want[r.payload_sha256][:2], want[r.payload_sha256][2].replace("bits=-0.0", "bits=0.0"))


def test_media_loses_nothing(tmp_path, docs):
    """Whatever byte is damaged, and wherever the archive is cut off, all rows come or an error does."""
    from inkwell.llm import media

    media.store_media(docs.where("doc_id IS NULL OR doc_id < 9").coalesce(1), f"file://{tmp_path}")
    archive = next(tmp_path.glob("*.tar"))
    good = archive.read_bytes()

    def rows(**options):
        reader = media.MediaReader({"path": f"file://{tmp_path}", "tries": "1", **options})
        return [r for part in reader.partitions() for b in reader.read(part) for r in zip(b.column(0).to_pylist(), b.column(4).to_pylist(), strict=True)]

    want = rows()
    assert len(want) == 11 and rows(rangeBytes="600") == want
    choose = random.Random(6)
    for at in [*range(0, 1600, 37), *(choose.randrange(len(good)) for _ in range(150)), *range(len(good) - 1100, len(good) - 1000, 9)]:
        archive.write_bytes(good[:at] + bytes([good[at] ^ 0x41]) + good[at + 1 :])
        for options in ({}, {"rangeBytes": "1024"}):
            try:
                assert rows(**options) == want
            except OSError:
                pass
    for length in (0, 100, 512, 3000, len(good) - 1, len(good) - 1024):
        archive.write_bytes(good[:length])
        with pytest.raises(OSError):
            rows(bytes=str(len(good)))
    archive.unlink()
    with pytest.raises(OSError):
        rows(archives="1")


def test_media_retries_a_member(tmp_path, spark, docs, monkeypatch):
    from inkwell.llm import media

    media.store_media(docs.coalesce(1), f"file://{tmp_path}")
    reader = media.MediaReader({"path": f"file://{tmp_path}"})
    failed = []
    decode = media.decode_image

    def flaky(image):
        if len(failed) < 1:
            failed.append(1)
            raise ValueError("once")
        return decode(image)

    monkeypatch.setattr(media, "decode_image", flaky)
    rows = sum(batch.num_rows for part in reader.partitions() for batch in reader.read(part))
    assert rows == len(ROWS) and failed


def brute_components(rows, words, percent):
    sets = {}
    for key, text, *_ in rows:
        if key is not None:
            w = spaced_words(text)
            sets[key] = frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()
    part = {k: k for k in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                old, new = max(part[a], part[b]), min(part[a], part[b])
                part = {k: new if v == old else v for k, v in part.items()}
    return sets, part


def test_sketch_distances(spark):
    """Sketches whose words differ in their top bits are as far as their bits say."""
    from inkwell.llm.minhash import sketch_forest

    rows = [(7, 1, 10, [0] * 8, 2), (7, 2, 10, [-1] + [0] * 7, 2), (8, 3, 10, [0] * 8, 2), (8, 4, 10, [-(1 << 63), *[0] * 7], 2)]
    frame = spark.createDataFrame(rows, "key long, id long, n_shingles long, sketch array<long>, size long")
    assert {tuple(r) for r in sketch_forest(frame, 80, 63).collect()} == {(4, 3)}
    assert {tuple(r) for r in sketch_forest(frame, 80, 64).collect()} == {(2, 1), (4, 3)}


def test_minhash_edges(docs, no_docs):
    from inkwell.llm.minhash import near_duplicates

    sets, part = brute_components(ROWS, 3, 85)
    rows = near_duplicates(docs, 3, 85).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and not r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), part[r.doc_id], part[r.doc_id] == r.doc_id)
    assert near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_minhash_brute_force(spark, words, percent, monkeypatch):
    from inkwell.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 16)
    choose = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = [choose.choice(vocabulary) for _ in range(choose.choice([20, 60, 150]))]
        for _ in range(60 if group == 0 else 6):
            copy = list(base)
            for _ in range(choose.randint(0, 4)):
                copy[choose.randrange(len(copy))] = choose.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    _, part = brute_components(rows, words, percent)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == part


def test_words_outlive_a_full_table(monkeypatch):
    """Ids stay the library's when words are forgotten again and again."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from inkwell.llm import packing

    monkeypatch.setattr(packing, "CACHE", 60)
    monkeypatch.setattr(packing, "LASTING", 25)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    with open(path, encoding="utf-8") as file:
        words = packing.WordTokenizer(file.read())
    choose = random.Random(11)
    some = ["".join(choose.choice("abcdeé漢1.,'") for _ in range(choose.randint(1, 9))) for _ in range(400)]
    for _ in range(60):
        texts = [" ".join(choose.choice(some) for _ in range(choose.randint(0, 30))) for _ in range(4)]
        want = [library.encode(text, add_special_tokens=False).ids for text in texts]
        assert [ids.tolist() for ids in words.encode(texts)] == want
