"""Which encoding bytes are in: byte order marks, strict UTF-8, and scores of what decoders make of them.

Windows are cut in the JVM, so of a long file only samples go to Python workers.
"""

from __future__ import annotations

import codecs
import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a sample. Fixed value.
SAMPLE = 64 * 1024
#: What the three deciders try, in order.
SCORED, WIDE = ("gb18030", "big5"), ("utf-16-le", "utf-16-be")
BODY = ("gb18030", "gbk", "utf-8", "gb2312", "big5", "utf-16")
WHOLE = ("utf-8", "utf-8-sig", "gb18030", "gbk", "big5", "utf-16", "utf-16-le", "utf-16-be")
#: Marks by encoding, longer ones first; signs of a wrong decoder.
MARKS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
GARBLED = re.compile(r"(?:锟斤拷|烫烫烫|屯屯屯|�|Ã.|Â.|姝ｆ枃|绗\S|鍗\S)")
#: Signs that are counted at a time, and the values of a byte that have each bit.
PART = 1 << 20
_WITH = [np.flatnonzero(np.arange(256) >> bit & 1) for bit in range(8)]
#: Margins to the runner-up. Fixed values.
HIGH, LOW = 0.05, 0.02

_DECISION = "encoding string, confidence string, score double, margin double"


def sample_parts(content: Column, size: int = SAMPLE) -> Column:
    """The whole of a short file, else its first, middle and last bytes."""
    n = F.octet_length(content)
    part = lambda start: F.substring(content, start.cast("int") + 1, F.lit(size))
    three = F.array(part(F.lit(0)), part(F.floor(n / 2) - size // 2), part(n - size))
    return F.when(n <= 2 * size, F.array(content)).otherwise(three)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """What each sign counts as, in bits: printable, ideograph, ideograph of the first block, replacement, NUL, other control, other of Unicode's C, Latin-1."""
    signs = [chr(i) for i in range(sys.maxunicode + 1)]
    kind = [unicodedata.category(sign) for sign in signs]
    kinds = np.array([sign.isprintable() for sign in signs], np.uint8)
    for bit, first, last in ((2, "㐀", "鿿"), (2, "豈", "\ufaff"), (4, "一", "鿿"), (8, "�", "�"), (16, "\0", "\0"), (128, "\x80", "\xff")):
        kinds[ord(first) : ord(last) + 1] |= bit
    kinds |= 32 * np.array([name == "Cc" for name in kind], np.uint8) | 64 * np.array([name[0] == "C" for name in kind], np.uint8)
    for sign in "\r\n\t":
        kinds[ord(sign)] = 1
    return kinds


def _counts(text: str) -> list[int]:
    """How many signs of a text are of each kind, in the order of the bits of ``_kinds``; each sign is looked up once."""
    kinds = _kinds()
    both = np.zeros(256, np.int64)
    for start in range(0, len(text), PART):
        codes = np.frombuffer(text[start : start + PART].encode("utf-32-le", "surrogatepass"), np.uint32)
        both += np.bincount(kinds[codes], minlength=256)
    return [int(both[_WITH[bit]].sum()) for bit in range(8)]


def _shares(text: str) -> tuple[float, float, float, float, int]:
    """Of a text: ideographs, printable signs, replaced ones, NULs, and the number of other controls, all but the last as shares."""
    n = len(text)
    printable, han, _, replaced, nuls, controls, _, _ = _counts(text)
    return han / n, printable / n, replaced / n, nuls / n, controls


def sample_score(text: str) -> float:
    """SC7: how much a decoded sample looks like text."""
    if not text:
        return -10.0
    han, printable, replaced, _, controls = _shares(text)
    return 0.55 * han + 0.45 * printable - 8.0 * replaced - 5.0 * controls / len(text) - min(0.5, 100.0 * len(GARBLED.findall(text)) / len(text))


def body_score(text: str) -> float:
    """SC8: how much a decoded response looks like text."""
    if not text:
        return -1.0
    han, printable, replaced, nuls, _ = _shares(text)
    return 0.6 * han + 0.4 * printable - 2.0 * replaced - 5.0 * nuls


def whole_score(text: str) -> float:
    """SC9: how much a strictly decoded file looks like text."""
    if not text:
        return -1e9
    n = len(text)
    printable, _, han, replaced, nuls, _, odd, latin = _counts(text)
    return 80 * (printable / n) + 120 * han / n - 50 * (replaced / n) * n - 20 * (nuls / n) * n - 5 * odd - 20 * latin / n


def is_utf8(sample: bytes) -> bool:
    """Whether a sample is UTF-8 but for up to three bytes of a sign cut at either end."""

    def fits(part: bytes) -> bool:
        try:
            part.decode("utf-8")
        except UnicodeDecodeError:
            return False
        return True

    return not sample or any(fits(sample[first : len(sample) - last]) for first in range(4) for last in range(4) if first < len(sample) - last)


def decide(samples: list[bytes]) -> tuple[str, str, float, float]:
    """SC7: encoding, confidence, score and margin of a file's samples."""
    for mark, name in MARKS:
        if samples[0].startswith(mark):
            return name, "high", 1.0, 1.0
    if all(map(is_utf8, samples)):
        return "utf-8", "high", 1.0, 1.0
    wide = sum(sample.count(0) for sample in samples) >= 0.08 * sum(map(len, samples))
    scores = {name: sum(sample_score(sample.decode(name, "replace")) for sample in samples) / len(samples) for name in (*(WIDE if wide else ()), *SCORED)}
    first, second, *_ = sorted(scores, key=scores.get, reverse=True)
    margin = scores[first] - scores[second]
    return first, "high" if margin >= HIGH else "low" if margin >= LOW else "ambiguous", round(scores[first], 6), round(margin, 6)


def _tried(raw: bytes, name: str | None, errors: str = "strict") -> str | None:
    try:
        return raw.decode(name, errors) if name else None
    except (LookupError, UnicodeError):
        return None


def _best(raw: bytes, names: tuple[str, ...], score: Callable[[str], float], errors: str) -> str | None:
    """The first name with the largest score of those that decode."""
    scores = {name: score(text) for name in names if (text := _tried(raw, name, errors)) is not None}
    return max(scores, key=scores.get, default=None)


def body_name(raw: bytes, declared: str | None, named: str | None) -> str:
    """SC8: a declared charset that decodes, else the page's own, else the best of BODY."""
    for name, least in ((declared, -0.5), (named, 0.0)):
        text = _tried(raw, name)
        if text is not None and body_score(text) > least:
            return name
    return _best(raw, BODY, body_score, "replace") or "utf-8"


def file_encoding(content: Column, size: int = SAMPLE) -> Column:
    """SC7: encoding, confidence (high, low or ambiguous), score and margin to the runner-up of a file's bytes.

    A byte order mark decides; then UTF-8, if all samples are; then the best of GB18030 and Big5, and of UTF-16 where eight per
    cent of the bytes are NUL. An empty file is UTF-8; null gives null.
    """

    @F.pandas_udf(_DECISION)
    def run(parts: pd.Series) -> pd.DataFrame:
        found = [(None,) * 4 if value is None or any(part is None for part in value) else decide([bytes(part) for part in value]) for value in parts]
        return pd.DataFrame(found, columns=["encoding", "confidence", "score", "margin"])

    return run(sample_parts(content, size))


def body_encoding(content: Column, content_type: Column) -> Column:
    """SC8: the encoding of a response body: the header's charset, else that of a meta element in the first 8,192 bytes, else the best score. Null gives null."""
    charset = lambda text, pattern: F.lower(F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1), F.lit("")))
    declared = charset(content_type, r"(?i)charset=([\w-]+)")
    head = F.decode(F.substring(content, 1, 8_192), "ISO-8859-1")
    named = charset(head, r"""(?i)<meta[^>]+charset=["']?\s*([\w-]+)""")

    @F.pandas_udf("string")
    def run(raw: pd.Series, header: pd.Series, meta: pd.Series) -> pd.Series:
        return pd.Series([None if value is None else body_name(bytes(value), a, b) for value, a, b in zip(raw, header, meta, strict=True)])

    return run(content, declared, named)


@F.pandas_udf(T.StringType())
def whole_encoding(content: pd.Series) -> pd.Series:
    """SC9: the best score of the encodings in which all of a file decodes strictly, else latin-1. Null gives null."""
    return pd.Series([None if raw is None else _best(bytes(raw), WHOLE, whole_score, "strict") or "latin-1" for raw in content])
