"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is fitted on all trusted documents (label quality 1, not toxic) but a fixed
share, by the hash of the id, that gives the limits. Its trigrams are counted in shards
by their middle word, so that a shard holds all that a pair or a context of that word
counts: highest-order counts, continuation counts below, and the weight that each context
leaves to the order below. Discounts come from the counts of counts of all shards. Words'
own counts are summed over the shards and joined to those that ask for them. A text's
trigrams go to the same shards, which answer a group of texts with a row of sums, one for each of its
texts that asked, so there are never more sums than words; nothing of the model goes
to the driver or to all workers but a bounded number of words. Words are dealt as hashes;
those that are frequent in a sample of texts are written as two-byte codes, the others in
full, so the sample changes what is stored and no result. A text's log probability
is a sum of one term for each n-gram: the words' own, and what the pair, the trigram and the
contexts change about it. The shards take turns, so that only a part of all trigrams
is on disk at a time. A document's mean log probability is drawn towards the trusted mean
as if it had a few more words, so a short text isn't rejected for a rare word. Limits are
quantiles of trusted documents that are never fitted on, by language, less a margin.

Results on unusual rows: a text that is null, empty or without words has perplexity null
and is kept; equal texts have equal perplexities; a null language or one with few trusted documents takes the limit of all
languages; without trusted documents nothing is rejected; null and repeated ids
are carried along; an empty table gives an empty result; other columns are carried along by
``filter_quality``, whatever their names, and ignored by ``perplexities``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.minhash import mixed
from inkwell.llm.workers import give_back
from inkwell.session import drop_stored, stored

#: Bytes of trusted text a shard in a turn, turns, tokens that are dealt out together, words whose own probability goes to all workers.
SHARD, TURNS, TOGETHER, FREQUENT = 8 << 20, 5, 1 << 19, 200_000
#: Words with a code of two bytes, and the texts that they are counted in, about.
CODES, SAMPLE = 65_535, 4_096
#: One trusted document in so many, by the hash of its id, is never fitted on; the limits come from these.
HELD = 5
#: Words by which a short text's mean is drawn towards the trusted mean.
DRAWN = 20
#: The share of trusted documents below a limit, the margin in log10 a word, and the least documents for a limit of a language's own.
QUANTILE, MARGIN, LEAST = 0.002, 0.15, 50

#: Bits of a word's hash; as what stands before a text's first word.
_WORD = np.uint64((1 << 48) - 1)
_START = np.uint64(0x1BD1E9955BD1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Rows of shards. Kinds: 0 trigrams of the model with counts, 1 trigrams of texts, 2 keys, sums and lengths of texts, 3 words of texts.
_NAMES = ["shard", "kind", "group", "two", "before", "word", "rare", "n"]
_SCHEMA = "shard int, kind int, group long, two binary, before binary, word binary, rare binary, n binary"
_ANSWERS = "group long, n binary, sums binary, keys binary, lengths binary"

#: The code of a word that is written in full.
_RARE = np.uint16(65_535)
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Hashes that a worker remembers, by a quicker hash of the word; longer words aren't remembered.
_SLOTS, _LONG = 21, 64
_REMEMBERED: list[np.ndarray] = []
#: Bytes of texts that are hashed together, few enough for a processor's cache.
_PIECE = 1 << 18
#: Rows that a shard answers together, and their tokens, about.
_ROWS, _TOKENS = 64, 1 << 17


def released(df: DataFrame, name: str) -> DataFrame:
    """``stored`` in less space, and the files of the shuffles that led there are deleted at once, not when the driver's memory is next collected."""
    conf = df.sparkSession.conf
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {key: conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        return stored(df, name)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(mixed(a * _GOLDEN) + b)


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct ones of 64-bit hashes, a place of each, and for each hash which of them it is."""
    # Places are sorted within the hashes' low bits, which is several times as fast as sorting places by hashes.
    low = np.uint64((1 << len(x).bit_length()) - 1)
    order = (np.sort((x & ~low) | np.arange(len(x), dtype=np.uint64)) & low).astype(np.int64)
    ordered = x[order]
    if (ordered[1:] < ordered[:-1]).any():  # two hashes differ in their low bits only
        order = np.argsort(x, kind="stable")
        ordered = x[order]
    new = np.ones(len(x), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(x), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ordered[new], order[new], inverse


def hashes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """What ``word_hashes`` gives for each text, one after the other, and how many words each has."""
    joined = b" ".join(texts).lower() + b" " * 9
    signs = np.frombuffer(joined, np.uint8)[:-8]
    solid = (signs != 32) & (signs - np.uint8(9) > np.uint8(4))
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if solid[0]:
        edges = np.append(0, edges)
    starts, ends = edges[::2], edges[1::2]
    length = ends - starts
    many = np.diff(np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)])))
    # Eight bytes of each word at a time.
    eight = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
    quick = mixed((eight[starts] & _LOW[np.minimum(length, 8)]) + length.astype(np.uint64) * _GOLDEN)
    at = np.flatnonzero(length > 8)
    for k in range(8, _LONG, 8):
        quick[at] = mixed(quick[at] * _GOLDEN + (eight[starts[at] + k] & _LOW[np.minimum(length[at] - k, 8)]))
        at = at[length[at] > k + 8]
    quick |= np.uint64(1)  # an empty slot has 0
    if not _REMEMBERED:
        _REMEMBERED.extend(np.zeros(1 << _SLOTS, np.uint64) for _ in range(2))
    names, values = _REMEMBERED
    slot = (quick >> np.uint64(64 - _SLOTS)).astype(np.int64)
    found = values[slot]
    new = np.flatnonzero((names[slot] != quick) & (length <= _LONG))
    _, first, inverse = _distinct(quick[new])
    fresh = hashlib.blake2b(digest_size=8).copy  # quicker than a new one

    def blake(at: np.ndarray) -> np.ndarray:
        out = []
        for low, high in zip(starts[at].tolist(), ends[at].tolist(), strict=True):
            word = fresh()
            word.update(joined[low:high])
            out.append(word.digest())
        return np.frombuffer(b"".join(out), "<u8")

    found[new] = blake(new[first])[inverse]
    names[slot[new]], values[slot[new]] = quick[new], found[new]
    at = np.flatnonzero(length > _LONG)
    found[at] = blake(at)
    return found, many


class Codes:
    """Two-byte codes of some words, that of what stands before a text's first word among them."""

    def __init__(self, words: np.ndarray):
        """``words``: the most frequent first."""
        words = np.append(_START, words[words != _START])[:CODES]
        self.words = np.append(words, np.full(int(_RARE) + 1 - len(words), ~np.uint64(0)))
        # Of words that share a slot the most frequent has it.
        self.by_slot = np.full(1 << 20, _RARE)
        self.by_slot[self._slot(words)[::-1]] = np.arange(len(words), dtype=np.uint16)[::-1]
        self._homes: dict[int, np.ndarray] = {}

    @staticmethod
    def _slot(words: np.ndarray) -> np.ndarray:
        return (words >> np.uint64(28)).astype(np.int64)

    def of(self, words: np.ndarray) -> np.ndarray:
        codes = self.by_slot[self._slot(words)]
        codes[self.words[codes] != words] = _RARE
        return codes

    def homes(self, shards: int) -> np.ndarray:
        """Shards of the words with codes, in 16 bits if they fit, which are sorted faster."""
        if shards not in self._homes:
            self._homes[shards] = _shard(self.words, shards).astype(np.uint16 if shards <= 1 << 16 else np.int32)
        return self._homes[shards]

    def read(self, rows: list[tuple]) -> list[np.ndarray]:
        """The words that ``Dealt.blobs`` wrote, of all rows."""
        codes = np.frombuffer(b"".join(part for row in rows for part in row[:3]), "<u2")
        words = self.words[codes]
        words[codes == _RARE] = _unpacked(b"".join(row[3] for row in rows))
        part = np.repeat(np.tile(np.arange(3, dtype=np.uint8), len(rows)), np.repeat([len(row[0]) // 2 for row in rows], 3))
        return [words[part == k] for k in range(3)]


class Dealt:
    """The trigrams of a group of texts, with codes and shards."""

    def __init__(self, hashes: np.ndarray, many: np.ndarray, codes: Codes, shards: int):
        self.of = np.repeat(np.arange(len(many), dtype="<u2"), many)
        starts = (np.cumsum(many) - many)[many > 0]
        self.word = hashes & _WORD
        self.code = codes.of(self.word)
        self.home = codes.homes(shards)[self.code]
        rare = np.flatnonzero(self.code == _RARE)
        self.home[rare] = _shard(self.word[rare], shards)
        self.before, self.code_before, self.shard = (_shifted(x, starts, first) for x, first in ((self.word, _START), (self.code, 0), (self.home, int(_shard(np.array([_START]), shards)[0]))))
        self.two, self.code_two = _shifted(self.before, starts, _START), _shifted(self.code_before, starts, 0)

    def blobs(self, here: np.ndarray) -> Iterator[tuple[int, np.ndarray, tuple[bytes, bytes, bytes, bytes]]]:
        """Each shard with trigrams at the places ``here``, its places, and the words written."""
        here = here[np.argsort(self.code_before[here], kind="stable")]
        here = here[np.argsort(self.shard[here], kind="stable")]
        codes, rare, upto = [], [], []
        for code, words in ((self.code_two, self.two), (self.code_before, self.before), (self.code, self.word)):
            written = code[here]
            full = written == _RARE
            codes.append(written.astype("<u2").tobytes())
            rare.append(_packed(words[here[full]]).tobytes())
            upto.append(np.append(0, 6 * np.cumsum(full)))
        low = 0
        for s, at in _cuts(self.shard, here):
            high = low + len(at)
            yield s, at, (*(c[2 * low : 2 * high] for c in codes), b"".join(r[u[low] : u[high]] for r, u in zip(rare, upto, strict=True)))
            low = high


def _shifted(x: np.ndarray, starts: np.ndarray, first: int) -> np.ndarray:
    """For each word what ``x`` has for the one before it."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[starts] = first
    return out


def discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more, from how many n-grams have the counts 1 to 4."""
    n = [counts.get(k, 0) for k in range(5)]
    if not (n[1] and n[2] and n[3]):
        return 0.5, 0.75, 0.9
    y = n[1] / (n[1] + 2 * n[2])
    raw = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3])
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def _off(n: np.ndarray, by_count: tuple[float, float, float]) -> np.ndarray:
    """What each count is discounted by."""
    return np.array([0.0, *by_count])[np.minimum(n, 3)]


def _packed(x: np.ndarray) -> np.ndarray:
    """The low six bytes of each number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _unpacked(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _shard(words: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(words) % np.uint64(shards)).astype(np.int32)


def _cuts(shard: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs and the places of its rows, in ``order``."""
    if not len(order):
        return
    dealt = shard[order]
    starts = np.append(0, np.flatnonzero(dealt[1:] != dealt[:-1]) + 1)
    for low, high in zip(starts, np.append(starts[1:], len(dealt)), strict=True):
        yield int(dealt[low]), order[low:high]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], _NAMES)


def frequent_words(texts: DataFrame) -> Codes:
    """Codes of the words that are most frequent in about SAMPLE of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, hashes, _ in _groups(batches):
            words, n = np.unique(hashes & _WORD, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])
        give_back()

    share = min(1.0, SAMPLE / max(texts.count(), 1))
    words = texts.select(F.col("text").cast("binary"), F.lit(0).cast("long").alias("key")).sample(share, seed=1).mapInArrow(run, "word long, n long")
    top = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(CODES).select("word").toArrow()  # CODES rows at most
    return Codes(top.column("word").to_numpy().astype(np.uint64))


def count_trigrams(texts: DataFrame, shards: int, codes: Codes) -> DataFrame:
    """Trigrams of texts with their counts in a group of texts, dealt by the middle word."""
    sent = texts.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, hashes, many in _groups(batches):
            dealt = Dealt(hashes, many, sent.value, shards)
            _, first, which = _distinct(_pair(_pair(dealt.two, dealt.before), dealt.word))
            counts = np.zeros(len(hashes), "<u4")
            counts[first] = np.bincount(which)
            yield _batch([(s, 0, 0, *blobs, counts[at].tobytes()) for s, at, blobs in dealt.blobs(first)])
        give_back()

    return texts.select(F.col("text").cast("binary"), F.lit(0).cast("long").alias("key")).mapInArrow(run, _SCHEMA)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, hashes and numbers of words of texts, about TOGETHER tokens of six bytes a group; groups without words are left out."""
    keys, texts, found, size, total = [], [], [], 0, 0

    def group() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        hashes, many = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(hashes):
            yield np.array(keys, "<i8"), hashes, many

    for batch in batches:
        for text, key in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            keys.append(key)
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            full = total + size >= 6 * TOGETHER or len(keys) >= 1 << 16
            if full or size >= _PIECE:
                found.append(hashes_of(texts))
                texts, size, total = [], 0, total + size
            if full:
                yield from group()
                keys, found, total = [], [], 0
    if texts:
        found.append(hashes_of(texts))
    if found:
        yield from group()


def _bunches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows that are answered together; the last column of each has two bytes a token."""
    bunch, total = [], 0
    for row in rows:
        bunch.append(row)
        total += len(row[-1]) // 2
        if len(bunch) >= _ROWS or total >= _TOKENS:
            yield bunch
            bunch, total = [], 0
    if bunch:
        yield bunch


class Trigrams:
    """The distinct trigrams of a shard, with the pairs and contexts that they make. All trigrams of a middle word are in one shard."""

    def __init__(self, rows: list[tuple], codes: Codes):
        two, before, words = codes.read(rows)
        n = np.frombuffer(b"".join(r[4] for r in rows), "<u4")
        context = _pair(two, before)
        self.key, first, inverse = _distinct(_pair(context, words))
        self.n = np.bincount(inverse, n, len(self.key)).astype(np.int64)
        before, words = before[first], words[first]
        self.contexts, _, self.of_context = _distinct(context[first])
        self.pair, first, self.of_pair = _distinct(_pair(before, words))
        self.pair_n = np.bincount(self.of_pair, minlength=len(self.pair))
        self.pair_word = words[first]
        self.before, _, self.of_before = _distinct(before[first])

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Words and the number of pairs here that they end."""
        return np.unique(self.pair_word, return_counts=True)


def _shares(n: np.ndarray, group: np.ndarray, by_count: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Each one's discounted share of its group, and what a group leaves to the order below."""
    off = _off(n, by_count)
    total = np.bincount(group, n)
    return (n - off) / total[group], np.bincount(group, off) / total


class Known:
    """Sorted distinct hashes of ``bits`` bits and a value of each.

    A hash's leading bits give its place but for a step or two, where a binary search takes one for each doubling of the hashes.
    """

    def __init__(self, hashes: np.ndarray, values: np.ndarray, bits: int = 64):
        lead = len(hashes).bit_length() + 1
        self.shift = np.uint64(bits - lead)
        self.first = np.append(0, np.cumsum(np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << lead))).astype(np.int32)
        # The last one stands for all that are beyond the others.
        self.hashes, self.values = np.append(hashes, ~np.uint64(0)), np.append(values, 0.0)

    def find(self, keys: np.ndarray, absent: float = 0.0) -> np.ndarray:
        """The value of each key, or ``absent``."""
        at = self.first[(keys >> self.shift).astype(np.int64)]
        there = self.hashes[at]
        behind = np.flatnonzero(there < keys)
        while len(behind):
            at[behind] += 1
            there[behind] = self.hashes[at[behind]]
            behind = behind[there[behind] < keys[behind]]
        return np.where((there == keys) & (at < len(self.hashes) - 1), self.values[at], absent)


def trusted_ids(labels: DataFrame, held: bool) -> DataFrame:
    """Ids of trusted documents: those for the limits, or those that may be fitted on."""
    share = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(HELD)) == 0
    ids = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("doc_id"))
    return ids.where(share if held else ~share).distinct()


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts of all trusted documents that may be fitted on."""
    return docs.join(trusted_ids(labels, False), "doc_id", "left_semi").select("text")


class Model:
    """Trigram counts in shards, the words that each shard needs, and what is known of all counts together."""

    def __init__(self, trigrams: DataFrame, words: DataFrame, shards: int, off: list[tuple[float, float, float]], pairs: int, unknown: float, frequent: tuple[np.ndarray, np.ndarray], codes: Codes):
        self.trigrams, self.words, self.shards, self.off, self.pairs, self.unknown = trigrams, words, shards, off, pairs, unknown
        known = Known(*frequent, bits=48)
        self.sent = words.sparkSession.sparkContext.broadcast((codes, known, known.find(codes.words & _WORD, 1.0)))

    def log_probabilities(self, hashes: np.ndarray) -> np.ndarray:
        """log10 of each word's probability after the two before it, for a text."""
        spark = self.words.sparkSession
        # A text that begins with the same words has the same probabilities for them.
        rows = [(k, (hashes[:k].astype("<u8")).tobytes()) for k in range(1, len(hashes) + 1)]
        frame = spark.createDataFrame(rows, "key long, text binary")
        sums = {r["key"]: r["total"] for r in self.sums(frame, hashed=True).collect()}
        return np.diff([sums.get(k, 0.0) for k in range(1, len(hashes) + 1)], prepend=0.0)

    def sums(self, texts: DataFrame, hashed: bool = False) -> DataFrame:
        """key, total, words: the sum of log10 probabilities and the number of words of the texts in rows (key, text).

        Rows with a key have equal texts. Texts without words give no row.
        """
        added = [F.sum(c).alias(c) for c in ("total", "words", "copies")]

        def add(rows: pa.Table) -> pa.Table:
            head = [(k, n) for k, n in zip(rows.column("keys").to_pylist(), rows.column("lengths").to_pylist(), strict=True) if k is not None]
            if len(head) != 1:
                raise RuntimeError("texts came in another order when they were read again")
            keys, lengths = (np.frombuffer(x, "<i8") for x in head[0])
            total = np.zeros(len(keys))
            for of, sums in zip(rows.column("n"), rows.column("sums"), strict=True):
                total[np.frombuffer(of.as_py(), "<u2")] += np.frombuffer(sums.as_py())
            some = np.flatnonzero((total != 0) | (lengths > 0))
            return pa.table({"key": keys[some], "total": total[some], "words": lengths[some], "copies": (lengths[some] > 0).astype(np.int64)})

        found = []
        for turn in range(TURNS):
            by_text = self._turn(texts, turn, hashed).groupBy("group").applyInArrow(add, "key long, total double, words long, copies long")
            found.append(released(by_text.groupBy("key").agg(*added), "sums"))
        whole = reduce(DataFrame.unionByName, found).groupBy("key").agg(*added)
        return whole.select("key", (F.col("total") / F.col("copies")).alias("total"), (F.col("words") / F.col("copies")).cast("long").alias("words"))

    def _turn(self, texts: DataFrame, turn: int, hashed: bool) -> DataFrame:
        """What the shards of a turn answer: for a group the numbers of texts in it and their sums, and once its texts' keys and lengths."""
        shards, off, pairs, unknown, sent = self.shards, self.off, self.pairs, self.unknown, self.sent

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, known, code_logs = sent.value
            if hashed:
                read = [(b.column(1).to_numpy(), [np.frombuffer(t, "<u8") for t in b.column(0).to_pylist()]) for b in batches]
                groups = ((k.astype("<i8"), np.concatenate(h), np.array([len(x) for x in h])) for k, h in read if h)
            else:
                groups = _groups(batches)
            for number, (keys, hashes, many) in enumerate(groups):
                # The keys are part of the group's name, so that a group that is read again in another order has another name.
                name = hashlib.blake2b(np.append(keys, [TaskContext.get().partitionId(), number]).tobytes(), digest_size=8)
                group = int.from_bytes(name.digest(), "little", signed=True)
                dealt = Dealt(hashes, many, codes, shards)
                of = dealt.of
                rows = [(s, 1, group, *blobs, of[at].tobytes()) for s, at, blobs in dealt.blobs(np.flatnonzero(dealt.shard % TURNS == turn))]
                # Frequent words' own probabilities are known here, the others are asked for.
                here = np.flatnonzero(dealt.home % TURNS == turn)
                own = code_logs[dealt.code[here]]
                rare = np.flatnonzero(dealt.code[here] == _RARE)
                own[rare] = known.find(dealt.word[here[rare]], 1.0)
                sums = np.bincount(of[here], np.where(own < 1.0, own, 0.0), len(keys))
                lengths = many if turn == 0 else np.zeros(len(keys))
                any_shard = turn + TURNS * (group % (shards // TURNS))
                rows.append((any_shard, 2, group, sums.tobytes(), lengths.astype("<i8").tobytes(), b"", b"", keys.tobytes()))
                here = here[own == 1.0]
                for s, at in _cuts(dealt.home, here[np.lexsort((dealt.word[here], dealt.home[here]))]):
                    rows.append((s, 3, group, b"", b"", b"", _packed(dealt.word[at]).tobytes(), of[at].tobytes()))
                dealt = hashes = None
                yield _batch(rows)
            give_back()

        def answer(own_words: pa.Table, blobs: pa.Table) -> pa.Table:
            kind = blobs.column("kind").to_numpy()
            codes = sent.value[0]
            columns = [blobs.column(c) for c in _NAMES[2:]]
            taken = lambda which: (tuple(c[int(i)].as_py() for c in columns) for i in np.flatnonzero(kind == which))
            word = own_words.column("word").to_numpy().astype(np.uint64)
            sort = np.argsort(word)
            c1 = own_words.column("c").to_numpy()[sort]
            word, p1 = word[sort], (c1 - _off(c1, off[0])) / max(pairs, 1) + unknown
            log1, p1 = Known(word, np.log10(p1), bits=48), Known(word, p1, bits=48)
            train = [row[1:] for row in taken(0)]
            known = len(train) > 0
            if known:
                t = Trigrams(train, codes)
                del train
                share2, left2 = _shares(t.pair_n, t.of_before, off[1])
                share3, left3 = _shares(t.n, t.of_context, off[2])
                lower = left2[t.of_before] * p1.find(t.pair_word, unknown)
                gain2 = np.log10(1 + share2 / lower)
                gain3 = np.log10(1 + share3 / (left3[t.of_context] * (share2 + lower)[t.of_pair]))
                left2, left3 = Known(t.before, np.log10(left2), bits=48), Known(t.contexts, np.log10(left3))
                gain2, gain3 = Known(t.pair, gain2), Known(t.key, gain3)
                del t, share2, share3, lower
            rows = [(group, np.arange(len(keys) // 8, dtype="<u2").tobytes(), own, keys, lengths) for group, own, lengths, _, _, keys in taken(2)]

            def add(bunch: list[tuple], logs: np.ndarray) -> None:
                of, n = np.frombuffer(b"".join(row[-1] for row in bunch), "<u2"), np.array([len(row[-1]) // 2 for row in bunch])
                # Each row has places of its own for the texts of its group.
                most = np.maximum.reduceat(of, np.cumsum(n) - n).astype(np.int64) + 1
                base = np.cumsum(most) - most
                at = np.repeat(base, n) + of
                asking = np.flatnonzero(np.bincount(at))
                cuts = np.append(np.searchsorted(asking, base), len(asking))
                of = (asking - np.repeat(base, np.diff(cuts))).astype("<u2")
                sums = np.bincount(at, logs)[asking]
                for row, low, high in zip(bunch, cuts, cuts[1:]):
                    rows.append((row[0], of[low:high].tobytes(), sums[low:high].tobytes(), None, None))

            # Without trigrams in this shard the words before leave all to the order below.
            for bunch in _bunches(taken(1)) if known else ():
                two, before, words = codes.read([row[1:5] for row in bunch])
                pair, context = _pair(before, words), _pair(two, before)
                add(bunch, left2.find(before) + left3.find(context) + gain2.find(pair) + gain3.find(_pair(context, words)))
            for bunch in _bunches(taken(3)):
                add(bunch, log1.find(_unpacked(b"".join(row[4] for row in bunch)), math.log10(unknown)))
            kinds = [pa.int64(), *[pa.binary()] * 4]
            out = pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["group", "n", "sums", "keys", "lengths"])
            give_back()
            return out

        asked = texts.select(F.col("text").cast("binary"), "key").mapInArrow(ask, _SCHEMA)
        blobs = self.trigrams.where(F.col("shard") % TURNS == turn).unionByName(asked)
        return self.words.where(F.col("shard") % TURNS == turn).groupBy("shard").cogroup(blobs.groupBy("shard")).applyInArrow(answer, _ANSWERS)


def fit(texts: DataFrame, size: int | None = None, codes: Codes | None = None) -> Model:
    """The model of all these texts, which have ``size`` bytes. ``codes`` change what is stored, no result."""
    if size is None:
        size = texts.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0
    shards = max(8, math.ceil(size / SHARD)) * TURNS
    if codes is None:
        codes = frequent_words(texts)
    trigrams = released(count_trigrams(texts, shards, codes), "trigrams")
    sent = texts.sparkSession.sparkContext.broadcast(codes)

    def words_of(table: pa.Table) -> pa.Table:
        t = Trigrams(list(zip(*[table.column(c).to_pylist() for c in _NAMES[3:]], strict=True)), sent.value)
        words, n = t.words()
        # The last rows count how many pairs, then trigrams, have the counts 1 to 4.
        many = [np.bincount(np.minimum(c, 5), minlength=6)[1:5] for c in (t.pair_n, t.n)]
        shard = table.column("shard")[0].as_py()
        give_back()
        return pa.table(
            {
                "kind": np.repeat(np.array([0, 1, 2], np.int32), [len(words), 4, 4]),
                "shard": np.full(len(words) + 8, shard, np.int32),
                "word": np.concatenate([words.astype(np.int64), [1, 2, 3, 4], [1, 2, 3, 4]]),
                "home": np.concatenate([_shard(words, shards), np.zeros(8, np.int32)]),
                "c": np.concatenate([n, *many]).astype(np.int64),
            }
        )

    found = released(trigrams.groupBy("shard").applyInArrow(words_of, "kind int, shard int, word long, home int, c long"), "words")
    counts: list[dict[int, int]] = [{}, {}, {}]
    for row in found.where("kind > 0").groupBy("kind", "word").agg(F.sum("c").alias("c")).collect():  # eight rows
        counts[row["kind"]][row["word"]] = row["c"]
    asked = found.where("kind = 0").select("shard", "word", "home", "c")
    one = released(asked.groupBy("word", "home").agg(F.sum("c").alias("c")), "word-pairs")
    for row in one.groupBy(F.least("c", F.lit(5)).alias("k")).agg(F.count("*").alias("many")).collect():  # five rows
        counts[0][row["k"]] = row["many"]
    distinct = sum(counts[0].values())
    pairs = one.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    off = [discounts(c) for c in counts]
    # What is left goes to all words and one unknown word alike.
    left = sum(off[0][min(k, 3) - 1] * many for k, many in counts[0].items())
    unknown = left / pairs / (distinct + 1) if pairs else 1e-7
    needed = asked.select("shard", "word").join(one.select("word", "c"), "word").unionByName(one.select("word", "c", F.col("home").alias("shard"))).select("shard", "word", "c")
    words = released(needed.groupBy("shard", "word").agg(F.first("c").alias("c")), "words-by-shard")
    top = one.orderBy(F.desc("c"), "word").limit(FREQUENT).select("word", "c").toArrow()  # FREQUENT rows at most
    known, c = top.column("word").to_numpy().astype(np.uint64), top.column("c").to_numpy().astype(np.int64)
    sort = np.argsort(known)
    frequent = known[sort], np.log10((c - _off(c, off[0])) / max(pairs, 1) + unknown)[sort]
    for table in (found, one):
        drop_stored(table)
    return Model(trigrams, words, shards, off, pairs, unknown, frequent, codes)


def with_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, key, total, words of docs (doc_id, lang, text): the text's hash, sum of log10 probabilities, number of words."""
    key = F.xxhash64(F.col("text").cast("binary")).alias("key")
    # Lengths alone are joined for the size, so that texts go through one shuffle at most.
    lengths = docs.select("doc_id", F.octet_length(F.col("text").cast("binary")).alias("size"))
    size = lengths.join(trusted_ids(labels, False), "doc_id", "left_semi").agg(F.sum("size")).first()[0]
    model = fit(trusted_texts(docs, labels), size or 0, frequent_words(docs))
    sums = model.sums(docs.select(key, "text"))
    scored = docs.select("doc_id", "lang", key).join(sums, "key", "left")
    scored = released(scored.select("doc_id", "lang", "key", F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("words", F.lit(0)).alias("words")), "scored")
    for table in (model.trigrams, model.words):
        drop_stored(table)
    return scored


def limits(scored: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float, float]:
    """Least mean log10 probability by language, of all languages, and the trusted mean.

    ``scored`` has doc_id, lang, total and words. Quantiles are of the trusted documents
    that are held out of every fit; without any, nothing is rejected.
    """
    own = scored.where("words > 0").join(trusted_ids(labels, True), "doc_id", "left_semi")
    centre = own.agg(F.sum("total") / F.sum("words")).first()[0]
    if centre is None:
        return {}, float("-inf"), 0.0
    mean = (F.col("total") + DRAWN * centre) / (F.col("words") + DRAWN)
    low = lambda: F.percentile_approx(mean, QUANTILE, 10_000)
    rows = own.groupBy("lang").agg(low().alias("low"), F.count("*").alias("n")).collect()  # a row for each language
    return {row["lang"]: row["low"] - MARGIN for row in rows if row["lang"] is not None and row["n"] >= LEAST}, own.agg(low()).first()[0] - MARGIN, centre


def _judged(scored: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    by_language, overall, centre = limits(scored, labels)
    limit = F.lit(overall)
    for language, low in by_language.items():
        limit = F.when(F.col("lang") == language, low).otherwise(limit)
    mean = (F.col("total") + DRAWN * centre) / (F.col("words") + DRAWN)
    return scored.select(*keep, mean.alias("mean"), limit.alias("limit")).withColumn("kept", (F.col("words") == 0) | (F.col("mean") >= F.col("limit")))


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, n_words, log10_prob, perplexity, mean_log, limit_log, kept."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text").cast("string").alias("text"))
    scored = with_scores(source, labels)
    judged = _judged(scored, labels, ["doc_id", "lang", "words", "total"])
    perplexity = F.when(F.col("words") > 0, F.pow(F.lit(10.0), -F.col("total") / F.col("words")))
    return judged.select("doc_id", "lang", F.col("words").alias("n_words"), F.col("total").alias("log10_prob"), perplexity.alias("perplexity"), F.col("mean").alias("mean_log"), F.col("limit").alias("limit_log"), "kept")


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text reaches its language's limit, with their columns as they were."""
    source = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text").cast("string").alias("text"))
    scored = with_scores(source.select("doc_id", "lang", "text"), labels)
    dropped = released(_judged(scored, labels, ["key", "lang", "words"]).where("NOT kept").select("key", F.col("lang").alias("its_lang")).distinct(), "dropped")
    rows = source.select("row", "lang", F.xxhash64(F.col("text").cast("binary")).alias("key"))
    kept = rows.join(dropped, (rows["key"] == dropped["key"]) & F.col("lang").eqNullSafe(F.col("its_lang")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
