"""Best-fit packing of token pieces into sequences.

One pass tokenizes whole texts, cuts only what is longer than a sequence, and
keeps a short row per piece. The plan is made over the histogram of lengths, whose
size the sequence length bounds: lengths come in falling order, and all pieces of
a length go at once into the fullest sequences that hold them. A plan row says
which ranks of a length take which sequences at which offset; pieces find theirs
by joining on length and rank. Ranks are counted within hashed shares of a length
and shifted by the shares before, so a length that a third of all rows have is
still ranked in many tasks.

Results on unusual rows: a null or empty text is the end id alone; equal texts get
equal pieces in different places; rows that repeat an id are packed each; a null id
is carried along; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.workers import give_back
from inkwell.session import stored

#: Most words whose ids a worker remembers, and the first ones, mostly frequent, that outlive a full table.
CACHE, LASTING = 400_000, 200_000
#: Pieces that a share of a length is to hold about.
SHARE = 20_000

#: White space as the tokenizers library sees it.
_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
_PYTHON_ONLY = re.compile("[\x1c-\x1f]")
#: Letters beyond the Latin ones, and the one whose lower case is two signs.
_UNLIKE = re.compile("[\u0130\u0250-\U0010ffff]")
#: What keeps a text from the short way: such letters, Python's own white space, and a sign that a full stop or comma continues.
_UNSAFE = re.compile("[\u0130\x1c-\x1f\u0250-\U0010ffff]")
_CONTINUED = re.compile("[.,](?<![0-9A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f][.,])(?:[ \n]|\\Z)")


class Numbers(dict):
    """Words by number; a new word takes the next number and is listed in ``new``."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordTokenizer:
    """Ids of texts by a tokenizer that lowers case and drops white space, remembered word by word.

    In texts of Latin letters, full stops and commas behind a letter or digit count as words
    of their own, which leaves the pretokens as they are and the words fewer. New words of
    letters alone are tokenized together: each gives one token with a word end, by which
    their ids are told apart. All other words are tokenized by themselves.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        data = json.loads(spec)
        suffix = data["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[token for text, token in vocab.items() if text.endswith(suffix)]] = True
        self.joins = bool(suffix)
        self.marks = [item["content"][:2] for item in data["added_tokens"]]
        self.reset()

    def forget(self) -> None:
        """Keep the words that came first."""
        lasting = min(LASTING, len(self.index))
        words = list(islice(self.index, lasting))
        self.index.clear()
        self.index.update(zip(words, range(lasting), strict=True))
        self.used = int((self.start[:lasting] + self.size[:lasting]).max(initial=0))

    def reset(self) -> None:
        """Forget what was cached."""
        self.index = Numbers()
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.used = 0

    def _keep(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.used += len(ids)

    def _fill(self) -> None:
        """Tokenize the words that are new."""
        words, self.index.new = self.index.new, []
        first = len(self.index) - len(words)
        while len(self.index) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        plain = np.array([self.joins and w.isalpha() and (w.isascii() or not _UNLIKE.search(w)) for w in words], bool)
        together = [w for w, is_plain in zip(words, plain, strict=True) if is_plain]
        if together:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(together)], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(together):
                raise ValueError("a word gave more or less than one word end")
            self._keep(first + np.flatnonzero(plain), ids, np.diff(cuts, prepend=0))
        if len(together) < len(words):
            other = [w for w, is_plain in zip(words, plain, strict=True) if not is_plain]
            made = [one.ids for one in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
            self._keep(first + np.flatnonzero(~plain), np.array([t for ids in made for t in ids], np.int64), np.array(list(map(len, made)), np.int64))

    def _words(self, text: str) -> list[str]:
        if text and not (_UNSAFE.search(text) or _CONTINUED.search(text) or any(mark in text for mark in self.marks)):
            text = text.lower().replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n").replace(",\n", " ,\n")
            return (f"{text[:-1]} {text[-1]}" if text[-1] in ".," else text).split()
        return [w for w in _SPACE.split(text) if w] if _PYTHON_ONLY.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.index) > CACHE or self.used > 16 * CACHE:
            self.forget()
            if self.used > 8 * CACHE:
                self.reset()
        number = self.index.__getitem__
        found = [np.fromiter(map(number, words), np.int64, len(words)) for words in map(self._words, texts)]
        if self.index.new:
            self._fill()
        at = np.concatenate([np.zeros(0, np.int64), *found])
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        all_ids = self.ids[np.repeat(self.start[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        last = np.cumsum(np.array(list(map(len, found)), np.int64))
        stops = np.concatenate([[0], ends])[last]
        return np.split(all_ids, stops[:-1]) if texts else []


_TOKENIZERS: dict[str, WordTokenizer] = {}


def shared_tokenizer(spec: str) -> WordTokenizer:
    """One tokenizer for each file and worker process."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordTokenizer(spec)
    return _TOKENIZERS[key]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        words = shared_tokenizer(spec.value)
        end = int(end_id).to_bytes(4, "little")
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                batch = whole.slice(first, 1024)
                rows, pieces, starts, lengths, sums = [], [], [], [], []
                for row, ids in enumerate(words.encode([x or "" for x in batch.column(1).to_pylist()])):
                    whole_ids = ids.astype("<u4").tobytes() + end
                    total = len(ids) + 1
                    for piece, start in enumerate(range(0, total, capacity)):
                        rows.append(row)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(min(capacity, total - start))
                        sums.append(zlib.crc32(whole_ids[4 * start : 4 * (start + capacity)]))
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
            batch = columns = whole = None
            give_back()

    return source.mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, count, first sequence, offset) of best-fit over counts."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by what is free: (first sequence, count)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def fill(length: int, rank: int, left: int, free: int, first: int, count: int) -> int:
        """Put up to ``left`` pieces into ``count`` like sequences; how many went in."""
        each = free // length
        full = min(count, left // each)
        for turn in range(each if full else 0):
            rows.append((length, rank + turn * full, full, first, capacity - free + turn * length))
        if full:
            room[free - each * length].append((first, full))
        rest = min(left - full * each, each) if full < count else 0
        for turn in range(rest):
            rows.append((length, rank + full * each + turn, 1, first + full, capacity - free + turn * length))
        if rest:
            room[free - rest * length].append((first + full, 1))
        untouched = count - full - bool(rest)
        if untouched:
            room[free].append((first + full + bool(rest), untouched))
        return full * each + rest

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        for free in range(length, capacity):
            while left and room[free]:
                first, count = room[free].pop()
                done = fill(length, rank, left, free, first, count)
                rank, left = rank + done, left - done
            if not left:
                break
        if left:
            opened = -(-left // (capacity // length))
            fill(length, rank, left, capacity, sequences, opened)
            sequences += opened
    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    schema = "length long, first_rank long, slots long, first_sequence long, first_offset long"
    # A length splits few of the groups of like sequences, so the plan's size follows the capacity, not the input.
    slots = spark.createDataFrame(plan(histogram, capacity), schema)
    shares = 64 + sum(histogram.values()) // SHARE
    shared = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares)))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    shifts = shared.groupBy("length", "share").count().select("length", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32")
    ranked = shared.withColumn("place", F.row_number().over(within) - 1).join(shifts, ["length", "share"]).withColumn("rank", F.col("place") + F.col("shift"))
    inside = (ranked["rank"] >= slots["first_rank"]) & (ranked["rank"] < slots["first_rank"] + slots["slots"])
    placed = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & inside)
    return placed.select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32", (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), F.col("first_offset").alias("offset")
    )
