"""LM scoring by a hidden Markov language model.

One pass counts every training token; the counts are summed by word and written.
The most frequent words become the model's symbols, the more of them the more training
tokens there are; all others share one symbol, within which a word has its smoothed
share of the counts; so the model gives every text a probability. Baum-Welch runs over
all training texts: tasks sum expected counts of starts, moves and emissions over their
texts, the sums meet by symbol and state, and the driver, which sees no more than
symbols x states numbers, forms the next model, until the likelihood hardly rises.
Scores come from the scaled forward recursion over whole texts.

A long text is worked on in stretches side by side. What each stretch does to the
states is a matrix, found by running it from every state; products of these hand the
exact forward and backward values to the ends of all stretches.

Counts of the most frequent words, a bounded table, go to all workers; the rest are
found by joining a text's remaining words with the counts.

Results on unusual rows: a null or empty text is one end token; a null id has
held_out true, as nothing is learned from it; equal texts have equal scores; rows that
repeat an id are scored each; an empty table gives an empty result, and a
table without training texts scores with uniform states; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.workers import give_back
from inkwell.session import stored

#: Least symbols with an emission of their own (beyond, the root of the number of training tokens), hidden states.
SYMBOLS, STATES = 4_096, 8
#: Most rounds of Baum-Welch, and the rise in log10 likelihood a token below which they end.
ROUNDS, RISE = 3, 1e-4
#: Tokens in a stretch of a text.
STRETCH = 1_024
#: Most words whose counts go to all workers.
FREQUENT = 200_000
#: Words that a task counts before it passes them on; tokens that run side by side.
COUNTED, TOGETHER = 200_000, 1 << 19
#: The end token; words hold no white space.
END = b" "


def tokens(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, then one end."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def count_words(docs: DataFrame) -> DataFrame:
    """word, c: counts over the texts that aren't held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "c"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update(tokens(text.as_py()))
                if len(counts) >= COUNTED:
                    yield flush()
        yield flush()
        give_back()

    return docs.where("NOT held_out").select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words and their counts, FREQUENT at most, most frequent first.

    Sixteenths of powers of two are counted first, so that no task sends more words
    to the driver than are kept.
    """
    step = F.floor(F.log2("c") * 16)
    sizes = {row["step"]: row["count"] for row in counts.groupBy(step.alias("step")).count().collect()}  # a thousand rows at most
    least, held, part = None, 0, 1.0
    for own in sorted(sizes, reverse=True):
        if held + sizes[own] > FREQUENT:
            if not held:  # a single step with too many words: a share of them by hash
                least, part = own, FREQUENT / sizes[own]
            break
        held += sizes[own]
        least = own
    if least is None:
        return [], np.zeros(0, np.int64)
    chosen = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < math.floor(part * (1 << 30))
    top = counts.where((step >= least) & chosen).toPandas().sort_values(["c", "word"], ascending=[False, True], kind="stable")
    return [bytes(w) for w in top["word"]], top["c"].to_numpy(np.int64)


def encode(docs: DataFrame, frequent: list[bytes], counts: np.ndarray, symbols: int) -> DataFrame:
    """Symbols of every text, sums over its frequent words, and its other words.

    The sums are of log10(c + 0.1): ``base_log`` over frequent words, ``rest_log``
    over those that share the last symbol.
    """
    index = docs.sparkSession.sparkContext.broadcast((frequent, np.log10(counts + 0.1)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {id_type}, held_out boolean, n_tokens long, n_frequent long, n_rest long, base_log double, rest_log double, symbols binary, others array<struct<word:binary,n:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, logs = index.value
        code_type = code_type_of(symbols)
        get = dict(zip(words, range(len(words)), strict=True)).get
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "held_out", "n_tokens", "n_frequent", "n_rest", "base_log", "rest_log", "symbols", "others"]
        other_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                out: list[list] = [[] for _ in range(8)]
                for text in batch.column(2):
                    found = tokens(text.as_py())
                    at = np.array(list(map(get, found, repeat(-1))), np.int64)
                    known = at[at >= 0]
                    rest = known[known >= symbols]
                    others = Counter(found[i] for i in np.flatnonzero(at < 0).tolist())
                    row += 1
                    codes = np.where((at < 0) | (at >= symbols), symbols, at).astype(code_type)
                    values = (row, len(found), len(known), len(rest) + len(found) - len(known), float(logs[known].sum()), float(logs[rest].sum()), codes.tobytes(), [{"word": w, "n": n} for w, n in others.items()])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), other_type]
                arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([arrays[0], batch.column(0), batch.column(1), *arrays[1:]], names)
            give_back()

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def code_type_of(symbols: int) -> str:
    """The type of a symbol's code, of which there are one more than symbols."""
    return "<u2" if symbols < 1 << 16 else "<u4"


class Model:
    """Starts, moves and emissions of a hidden Markov model."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (S), (S, S), (S, symbols)

    @classmethod
    def first(cls, counts: np.ndarray, states: int) -> Model:
        """States that favour different words, at random but always alike, around the words' shares."""
        random = np.random.default_rng(11)
        emit = (counts + 0.1) * np.exp(random.normal(0, 1, (states, len(counts))))
        move = np.full((states, states), 1.0) + 4 * np.eye(states) + random.random((states, states)) * 0.1
        return cls(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
        """The model of expected counts, each smoothed; ``share`` are the words' overall shares."""
        start, move = start + 0.1, move + 0.1
        emit = emit + 1.0 * share[None, :]
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def shares(self) -> np.ndarray:
        """The states' shares in the long run."""
        now = np.full(len(self.start), 1 / len(self.start))
        for _ in range(200):
            now = now @ self.move
        return now / now.sum()


class Lanes:
    """Sequences side by side, longest first: step t holds those longer than t."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(x) for x in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
        self.begin = np.concatenate([[0], np.cumsum(self.active)])
        self.symbols = np.empty(self.begin[-1], np.int64)
        for lane, which in enumerate(self.order):
            self.symbols[self.begin[: lengths[lane]] + lane] = sequences[which]

    def forward(self, model: Model, start: np.ndarray, keep: bool, ends: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """log10 of each lane's probability; scaled forward values, or those of the lanes' ends only, and scales if kept."""
        emit = np.ascontiguousarray(model.emit.T)
        logs = np.zeros(len(self.order))
        values = np.empty((self.begin[-1], len(model.start))) if keep else np.empty((len(self.order), len(model.start))) if ends else None
        scales = np.empty(self.begin[-1] if keep else 0)
        now = start[self.order]
        for t, n in enumerate(self.active):
            low, high = self.begin[t], self.begin[t + 1]
            now = (now if t == 0 else now[:n] @ model.move) * emit[self.symbols[low:high]]
            scale = now.sum(1)
            now = now / scale[:, None]
            logs[:n] += np.log10(scale)
            if keep:
                values[low:high], scales[low:high] = now, scale
            elif ends:
                values[:n] = now
        out = np.empty(len(logs))
        out[self.order] = logs
        return out, values, scales

    def expected(self, model: Model, start: np.ndarray, opens: np.ndarray, end: np.ndarray | None = None, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts (of lanes that open a text), moves and emissions, and the log10 likelihood of the lanes.

        ``end`` are backward values at the lanes' ends up to a factor, all ones where texts end;
        ``before`` the scaled forward values just before a lane, for those that don't open a text.
        """
        states = len(model.start)
        logs, values, scales = self.forward(model, start, True)
        emit = np.ascontiguousarray(model.emit.T)
        end = np.ones((len(self.order), states)) if end is None else end[self.order]
        after = np.ones((0, states))
        moves = np.zeros_like(model.move)
        weights = np.empty_like(values)
        for t in range(len(self.active) - 1, -1, -1):
            low, high = self.begin[t], self.begin[t + 1]
            n, m = high - low, len(after)
            back = np.empty((n, states))
            if m:
                back[:m] = after @ model.move.T
                moves += values[low : low + m].T @ after
            if m < n:  # lanes that end here
                own = values[low + m : high]
                back[m:] = end[m:n] / (own * end[m:n]).sum(1, keepdims=True)
            weights[low:high] = values[low:high] * back
            after = back * emit[self.symbols[low:high]] / scales[low:high, None]
        opens = opens[self.order]
        if before is not None and not opens.all():
            moves += before[self.order][~opens].T @ after[~opens]
        weights /= weights.sum(1, keepdims=True)
        emits = np.stack([np.bincount(self.symbols, weights=weights[:, s], minlength=model.emit.shape[1]) for s in range(states)])
        return weights[: self.active[0]][opens].sum(0), moves * model.move, emits, float(logs.sum())


class Stretches:
    """Texts side by side, each cut in stretches of bounded length, with exact values at the cuts."""

    def __init__(self, model: Model, texts: list[np.ndarray]):
        self.model = model
        counts = np.array([max(1, -(-len(x) // STRETCH)) for x in texts])
        self.parts = [x[at : at + STRETCH] for x in texts for at in range(0, len(x), STRETCH)]
        first = np.cumsum(counts) - counts
        self.opens = np.zeros(len(self.parts), bool)
        self.opens[first] = True
        self.before = np.zeros((len(self.parts), len(model.start)))  # forward values at the end of the stretch before
        self.end = np.ones_like(self.before)  # backward values at a stretch's end
        self.logs = np.zeros(len(texts))  # log10 of each text's probability
        self.start = np.tile(model.start, (len(self.parts), 1))
        cut = np.flatnonzero(counts > 1)
        whole = np.flatnonzero(counts == 1)
        self._whole, self._first = whole, first
        if len(cut):
            self._hand_over([(text, range(first[text], first[text] + counts[text])) for text in cut])

    def _blocks(self, at: np.ndarray) -> Iterator[np.ndarray]:
        """Some stretches at a time, so that what is held is bounded however long a text is."""
        ends = np.cumsum([len(self.parts[k]) for k in at])
        yield from filter(len, np.split(at, np.searchsorted(ends, np.arange(TOGETHER, ends[-1] if len(ends) else 0, TOGETHER))))

    def _matrices(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each stretch and state before it, log10 of the stretch's probability and the states' shares at its end."""
        states = len(self.model.start)
        # A text's first stretch goes from its start, by as many equal lanes.
        starts = np.where(self.opens[at][:, None, None], self.model.start[None, None, :], self.model.move[None, :, :])
        lanes = Lanes([self.parts[k] for k in at for _ in range(states)])
        logs, ends, _ = lanes.forward(self.model, starts.reshape(-1, states), False, ends=True)
        rows = np.empty_like(ends)
        rows[lanes.order] = ends
        return logs.reshape(-1, states), rows.reshape(-1, states, states)

    def _hand_over(self, runs: list[tuple[int, range]]) -> None:
        states = len(self.model.start)
        at = np.concatenate([np.array(places) for _, places in runs])
        found = [self._matrices(at[k : k + 64]) for k in range(0, len(at), 64)]
        logs, rows = (np.concatenate(x) for x in zip(*found, strict=True))
        top = logs.max(1)
        weight = 10.0 ** (logs - top[:, None])
        place = 0
        for text, places in runs:
            held = np.full(states, 1 / states)
            for k, stretch in enumerate(places, place):
                self.before[stretch] = held
                mix = held * weight[k]
                self.logs[text] += top[k] + math.log10(mix.sum())
                held = mix @ rows[k] / mix.sum()
            back = np.ones(states)
            for k, stretch in zip(range(place + len(places) - 1, place - 1, -1), reversed(places), strict=True):
                self.end[stretch] = back
                back = weight[k] * (rows[k] @ back)
                back /= back.max()
            place += len(places)
        behind = ~self.opens
        self.start[behind] = self.before[behind] @ self.model.move

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts, moves and emissions, and the log10 likelihood of all texts."""
        found = []
        # By length, so that stretches of like length are side by side.
        for at in self._blocks(np.argsort([len(x) for x in self.parts], kind="stable")):
            found.append(Lanes([self.parts[k] for k in at]).expected(self.model, self.start[at], self.opens[at], self.end[at], self.before[at]))
        return tuple(sum(x) for x in zip(*found, strict=True))

    def scores(self) -> np.ndarray:
        """log10 of each text's probability."""
        if len(self._whole):
            at = self._first[self._whole]
            self.logs[self._whole] = np.concatenate([Lanes([self.parts[k] for k in block]).forward(self.model, self.start[block], False)[0] for block in self._blocks(at)])
        return self.logs


def batches_of(sequences: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    """Lists of (sequence, ...) of about ``size`` tokens together."""
    held: list[tuple] = []
    total = 0
    for item in sequences:
        held.append(item)
        total += len(item[0])
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def one_round(encoded: DataFrame, model: Model, share: np.ndarray) -> tuple[Model, float]:
    """The next model, and the log10 likelihood of the training texts under the last."""
    code_type = code_type_of(model.emit.shape[1] - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, symbols = model.emit.shape
        starts, moves, emits, total = np.zeros(states), np.zeros((states, states)), np.zeros((states, symbols)), 0.0
        texts = ((np.frombuffer(value.as_buffer(), code_type),) for batch in batches for value in batch.column(0))
        for group in batches_of(texts, TOGETHER):
            a, b, c, d = Stretches(model, [codes for codes, in group]).expected()
            starts, moves, emits, total = starts + a, moves + b, emits + c, total + d
            give_back()
        # Rows: emissions by symbol, then moves, starts, and the likelihood.
        table = np.concatenate([emits.T, moves, starts[None, :], np.full((1, states), total)])
        some = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, states), pa.int32()), pa.array(np.tile(np.arange(states), len(some)), pa.int32()), pa.array(table[some].ravel(), pa.float64())], ["at", "state", "v"]
        )

    rows = encoded.where("NOT held_out").select("symbols").mapInArrow(run, "at int, state int, v double").groupBy("at", "state").agg(F.sum("v").alias("v"))
    found = rows.toPandas()  # at most (symbols + states + 2) * states rows
    states, symbols = model.emit.shape
    table = np.zeros((symbols + states + 2, states))
    table[found["at"], found["state"]] = found["v"]
    return Model.from_counts(table[symbols + states], table[symbols : symbols + states], table[:symbols].T, share), float(table[-1, 0])


def forward_scores(encoded: DataFrame, model: Model) -> DataFrame:
    """row and model_log: log10 of the exact probability of each text's symbols."""
    code_type = code_type_of(model.emit.shape[1] - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[tuple[np.ndarray, int]]:
            for batch in batches:
                for value, row in zip(batch.column(1), batch.column(0).to_pylist(), strict=True):
                    yield np.frombuffer(value.as_buffer(), code_type), row

        for group in batches_of(texts(), TOGETHER):
            logs = Stretches(model, [codes for codes, _ in group]).scores()
            yield pa.RecordBatch.from_arrays([pa.array([row for _, row in group], pa.int64()), pa.array(logs, pa.float64())], ["row", "model_log"])
            give_back()

    return encoded.select("row", "symbols").mapInArrow(run, "row long, model_log double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held_out = F.coalesce(F.crc32(docs[id_col].cast("string")) % 10 == 0, F.lit(True))
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"), held_out.alias("held_out"))
    counts = stored(count_words(source), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words, top_counts = frequent_words(counts)
    symbols = min(max(SYMBOLS, math.isqrt(total)), len(words))
    encoded = stored(encode(source, words, top_counts, symbols), "encoded")

    rest_total, rest_distinct = total - int(top_counts[:symbols].sum()), distinct - symbols
    symbol_counts = np.append(top_counts[:symbols], rest_total).astype(float)
    share = (symbol_counts + 0.1) / (symbol_counts + 0.1).sum()
    model = Model.first(symbol_counts, STATES)
    before = -math.inf
    for _ in range(ROUNDS if total else 0):
        after, likelihood = one_round(encoded, model, share)
        if likelihood - before < RISE * total:
            break  # the last round hardly helped
        model, before = after, likelihood

    others = encoded.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.n")
    joined = others.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = joined.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.1)).alias("other_log"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("other_known"))
    scored = encoded.drop("symbols", "others").join(forward_scores(encoded, model), "row").join(sums, "row", "left")
    other_log = F.coalesce("other_log", F.lit(0.0))
    rest_base = math.log10(rest_total + 0.1 * (rest_distinct + 1))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("other_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_log") + other_log - F.col("n_tokens") * math.log10(total + 0.1 * (distinct + 1))).alias("base_score"),
        (F.col("model_log") + F.col("rest_log") + other_log - F.col("n_rest") * rest_base).alias("score"),
    )
