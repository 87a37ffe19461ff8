"""BPE encoding and decoding.

The encoder walks a pretoken once. An Aho-Corasick automaton over the vocabulary
gives the longest token at every position; a candidate is kept when the table of
compatible pairs says that the merge procedure would leave it beside its left
neighbour, else the next shorter prefix token is tried, else the last token is
taken back. Positions found to be dead ends are remembered, so each is tried once
and the work is linear in the pretoken. The result equals applying the merges in
rank order. Decoding copies token bytes by an offset table.

Results on unusual rows: a null or empty text has no tokens and decodes to "";
a literal of an added token becomes that token's id; ties and repeated rows get
the same values row by row; an empty table gives an empty result; other columns
of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Most chunks that a worker remembers, and how many of the first of them, mostly frequent ones, outlive a full table.
CACHE, KEPT = 900_000, 200_000

#: White space other than single spaces and line feeds between words.
UNUSUAL_SPACE = re.compile(r"[^\S\n ]|\s\s|\A\s|\s\Z")
#: A chunk up to a space before a word; a run of white space stays with what precedes it.
SPACED_CHUNK = re.compile(r"(?s).(?:(?! \S).)*")

# The byte-level alphabet maps printable bytes to themselves and the rest to 256 and up.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Code points that today's Unicode counts as letters or numbers and the tokenizers library doesn't.
_LATER = (
    "\\u0558\\u058b\\u058c\\u088f\\u0c5c\\u0cdc\\u208f\\u209d-\\u209f\\ua7ce\\ua7cf\\ua7d2\\ua7d4\\ua7dd\\ua7e2\\ua7f1"
    "\\uab6c\\uab6d\\U000107bb-\\U000107bf\\U00010940-\\U00010959\\U00010ec5-\\U00010ec7\\U00010ed9-\\U00010eee"
    "\\U00011b0a\\U00011db0-\\U00011ddb\\U00011de0-\\U00011de9\\U00011df1\\U0001246f\\U00012475-\\U0001247f"
    "\\U00012550-\\U00012686\\U00016ea0-\\U00016eb8\\U00016ebb-\\U00016ed3\\U00016ff2-\\U00016ff6"
    "\\U000187f8-\\U000187ff\\U00018cd6-\\U00018cda\\U00018d09-\\U00018d20\\U00018d80-\\U00018df2"
    "\\U00018e00-\\U00019191\\U000191a0-\\U000191d2\\U0001b123-\\U0001b128\\U0001b168\\U0001d6a6"
    "\\U0001df1f-\\U0001df24\\U0001df2b-\\U0001df81\\U0001df90-\\U0001df96\\U0001dfcd-\\U0001dfff"
    "\\U0001e6c0-\\U0001e6de\\U0001e6e0-\\U0001e6e2\\U0001e6e4\\U0001e6e5\\U0001e6e7-\\U0001e6ed"
    "\\U0001e6f0-\\U0001e6f4\\U0001e6fe\\U0001e6ff\\U0002b73a-\\U0002b73f\\U0002b81e\\U0002cea2-\\U0002cead"
    "\\U000323b0-\\U00033479\\U0003d000-\\U0003fc3f"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    letters = {byte: chr(byte) for byte in _PRINTABLE}
    spare = iter(range(256, 512))
    return [letters.get(byte) or chr(next(spare)) for byte in range(256)]


def pretoken_pattern() -> regex.Pattern:
    """Contractions, letters, numbers, other signs and white space of the byte-level pretokenizer."""
    letter, number = f"[\\p{{L}}--[{_LATER}]]", f"[\\p{{N}}--[{_LATER}]]"
    other = f"[^\\s{letter}{number}]"
    return regex.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\\s+(?!\\S)|\\s+", regex.V1
    )


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])


class Encoder:
    """Exact byte-level BPE of one tokenizer file's contents (``spec``: its JSON)."""

    def __init__(self, spec: str):
        import ahocorasick

        data = json.loads(spec)
        vocab: dict[str, int] = data["model"]["vocab"]
        added = {item["content"]: item["id"] for item in data["added_tokens"]}
        to_byte = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.size = {token: len(text) for text, token in vocab.items()}
        # Ranks order the merges; single bytes come before all of them.
        self.rank = {token: -1 for token in vocab.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            token = vocab[left + right]
            self.joined[vocab[left], vocab[right]] = token
            if token not in self.parts:
                self.rank[token], self.parts[token] = rank, (vocab[left], vocab[right])
        reachable = [text for text, token in vocab.items() if len(text) == 1 or token in self.parts]
        # The automaton reads bytes as the letters of the same numbers.
        self.longest = ahocorasick.Automaton()
        for text in reachable:
            self.longest.add_word(bytes(to_byte[x] for x in text).decode("latin-1"), vocab[text])
        self.longest.make_automaton()
        known = set(reachable)
        self.shorter: dict[int, int] = {}
        for text in reachable:
            cut = next((n for n in range(len(text) - 1, 0, -1) if text[:n] in known), 0)
            if cut:
                self.shorter[vocab[text]] = vocab[text[:cut]]
        self.fits: dict[int, bool] = {}  # by left << 32 | right
        # The offset table: bytes of token t are flat[start[t] : start[t] + length[t]].
        pieces: dict[int, bytes] = {token: bytes(to_byte[x] for x in text) for text, token in vocab.items()}
        pieces |= {token: text.encode() for text, token in added.items()}
        order = range(max(pieces) + 1)
        self.length = np.array([len(pieces.get(t, b"")) for t in order], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.flat = np.frombuffer(b"".join(pieces.get(t, b"") for t in order), np.uint8)
        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.pattern = pretoken_pattern()
        self.reset()

    def reset(self) -> None:
        """Forget what was cached."""
        self.words: dict[str, tuple[int, ...]] = {}  # pretokens that are no chunk of the spaced kind
        self.spaced: dict[str, int] = {}  # chunks that a space precedes, without it; or that begin with a line feed
        self.chunks: dict[str, int] = {}  # other chunks
        self.chunk_text: list[str] = []
        self.chunk_start = np.zeros(1024, np.int64)
        self.chunk_size = np.zeros(1024, np.int64)
        self.chunk_ids = np.zeros(4096, np.int32)
        self.used = 0

    def _shrink(self) -> None:
        """Forget all chunks but the first KEPT, which are mostly frequent ones."""
        self.words.clear()
        self.spaced = {text: index for text, index in self.spaced.items() if index < KEPT}
        self.chunks = {text: index for text, index in self.chunks.items() if index < KEPT}
        del self.chunk_text[KEPT:]
        last = len(self.chunk_text) - 1
        self.used = int(self.chunk_start[last] + self.chunk_size[last]) if last >= 0 else 0
        if self.used >= 8 * CACHE:
            self.reset()

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging in rank order leaves these two tokens side by side.

        Undo the merges of both, latest first: if at some time the pieces that
        touch form a pair whose merge comes earlier than the one undone, that
        merge would have happened first.
        """
        key = left << 32 | right
        bound = 1 << 60
        answer = True
        while True:
            token = self.joined.get((left, right))
            if token is not None and self.rank[token] < bound:
                answer = False
                break
            if self.rank[left] > self.rank[right]:
                bound, left = self.rank[left], self.parts[left][1]
            elif self.rank[right] >= 0:
                # At equal ranks both sides are the same token; the left one was made first.
                bound, right = self.rank[right] + 1, self.parts[right][0]
            else:
                break
        if len(self.fits) >= CACHE // 2:
            self.fits.clear()
        self.fits[key] = answer
        return answer

    def encode_pretoken(self, text: str) -> list[int]:
        """Ids of one pretoken by the backtracking walk."""
        letters = text.encode().decode("latin-1")
        n = len(letters)
        size, shorter, fits = self.size, self.shorter, self.fits
        best = [0] * n
        for end, token in self.longest.iter(letters):
            best[end - size[token] + 1] = token  # later ends are longer
        token = best[0]
        if size[token] == n:
            return [token]  # a whole token stands alone: nothing beside it to merge with
        ids: list[int] = [token]
        starts: list[int] = [0]
        dead = bytearray(n + 1)
        at = size[token]
        left, token = token, best[at]
        while True:
            end = at + size[token]
            if not dead[end]:
                fit = True if left < 0 else fits.get(left << 32 | token)
                if fit is None:
                    fit = self.compatible(left, token)
                if fit:
                    ids.append(token)
                    if end == n:
                        return ids
                    starts.append(at)
                    at, left, token = end, token, best[end]
                    continue
            if token in shorter:
                token = shorter[token]
            else:
                dead[at] = 1
                token, at = ids.pop(), starts.pop()
                left = ids[-1] if ids else -1
                # The token taken back is tried in its shorter forms only: its end is dead.

    def _pretokens(self, text: str) -> list[str]:
        body = text[1:] if text[0] in " \n" else text
        if body and max(body) < "\u0250":  # the common forms, without the pattern
            last = body[-1]
            word = body[:-1] if last in ".," and len(body) > 1 else body
            if word.isalpha():
                head = ["\n", word] if text[0] == "\n" else [text[: len(text) - len(body) + len(word)]]
                return head if word is body else [*head, last]
        return self.pattern.findall(text)

    def _chunk(self, text: str, table: dict[str, int], key: str) -> int:
        """The index of a chunk, which begins at a line feed or with the space before a word."""
        pretokens = self._pretokens(text)
        if len(pretokens) == 1:
            return self._keep(table, key, self.encode_pretoken(text))
        found: list[int] = []
        for word in pretokens:
            if word[0] == " " and len(word) > 1:  # a chunk of its own
                index = self.spaced.get(word[1:])
                if index is None:
                    ids = self.encode_pretoken(word)
                    if len(word) < 64:
                        self._keep(self.spaced, word[1:], ids)
                else:
                    start = self.chunk_start[index]
                    ids = self.chunk_ids[start : start + self.chunk_size[index]].tolist()
            else:
                ids = self.words.get(word)
                if ids is None:
                    ids = self.encode_pretoken(word)
                    if len(word) < 64:
                        self.words[word] = tuple(ids)
            found += ids
        return self._keep(table, key, found)

    def _keep(self, table: dict[str, int], key: str, found: list[int]) -> int:
        index = len(self.chunk_text)
        table[key] = index
        self.chunk_text.append(",".join(map(str, found)))
        if index == len(self.chunk_start):
            self.chunk_start = np.concatenate([self.chunk_start, np.zeros_like(self.chunk_start)])
            self.chunk_size = np.concatenate([self.chunk_size, np.zeros_like(self.chunk_size)])
        while self.used + len(found) > len(self.chunk_ids):
            self.chunk_ids = np.concatenate([self.chunk_ids, np.zeros_like(self.chunk_ids)])
        self.chunk_start[index], self.chunk_size[index] = self.used, len(found)
        self.chunk_ids[self.used : self.used + len(found)] = found
        self.used += len(found)
        return index

    def _plain(self, text: str) -> tuple[np.ndarray, list[str]]:
        """Ids of text without added tokens, as an array and as decimal strings."""
        if len(self.chunk_text) >= CACHE or len(self.words) >= KEPT or self.used >= 16 * CACHE:
            self._shrink()
        make, chunks = self._chunk, self.chunks
        if UNUSUAL_SPACE.search(text):
            index = []
            for chunk in SPACED_CHUNK.findall(text):
                index.append(i if (i := chunks.get(chunk)) is not None else make(chunk, chunks, chunk))
        else:
            # Each space or line feed stands alone before a word, so each opens a chunk.
            first, *pieces = text.replace("\n", " \n").split(" ")
            spaced = self.spaced
            index = list(map(spaced.get, pieces))
            if None in index:
                for at, known in enumerate(index):
                    if known is None:
                        piece = pieces[at]
                        known = spaced.get(piece)
                        index[at] = make(piece if piece[0] == "\n" else " " + piece, spaced, piece) if known is None else known
            index.insert(0, i if (i := chunks.get(first)) is not None else make(first, chunks, first))
        texts = self.chunk_text
        at = np.array(index, np.int64)
        return self.chunk_ids[spread(self.chunk_start[at], self.chunk_size[at])], [texts[i] for i in index]

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids of a whole text, and the same as decimals joined by commas."""
        if not text:
            return np.zeros(0, np.int64), ""
        arrays: list[np.ndarray] = []
        texts: list[str] = []
        for part in self.special.split(text) if self.special else [text]:
            if not part:
                continue
            token = self.added.get(part)
            if token is None:
                ids, decimals = self._plain(part)
                arrays.append(ids)
                texts += decimals
            else:
                arrays.append(np.array([token]))
                texts.append(str(token))
        return np.concatenate(arrays) if len(arrays) != 1 else arrays[0], ",".join(texts)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, copied by the offset table."""
        if not len(ids):
            return b""
        return self.flat[spread(self.start[ids], self.length[ids])].tobytes()


_ENCODERS: dict[str, Encoder] = {}


def shared_encoder(spec: str) -> Encoder:
    """One encoder for each tokenizer and worker process."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Token ids of whole texts, and the text that they decode to.

    Columns: the id, n_tokens, ids (if ``keep_ids``), ids_sha256, decoded (if
    ``keep_ids``), decoded_sha256. ``tokenizer`` is the path of a byte-level BPE
    file; its contents, whose size the vocabulary bounds, are broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(spec.value)
        for batch in batches:
            counts, hashes, decoded_hashes, all_ids, decoded = [], [], [], [], []
            for value in batch.column(1):
                ids, decimals = encoder.encode(value.as_py() or "")
                raw = encoder.decode_bytes(ids)
                try:
                    raw.decode()
                except UnicodeDecodeError:
                    raw = raw.decode("utf-8", "replace").encode()
                counts.append(len(ids))
                hashes.append(hashlib.sha256(decimals.encode()).hexdigest())
                decoded_hashes.append(hashlib.sha256(raw).hexdigest())
                if keep_ids:
                    all_ids.append(ids.astype(np.int32))
                    decoded.append(raw.decode())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded_hashes, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, schema)
