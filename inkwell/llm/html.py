"""HTML extraction by the maximum-scoring subsequence.

A page becomes a run of tokens: tags score below zero, words above, except that
words in containers which labelled pages keep outside their article score below
zero too. One pass finds the contiguous run with the largest sum; the element that
encloses it (an article or main element, or the innermost one that holds all of the
run's blocks) is the content region, and its blocks are joined, without those
in boilerplate containers. The weights are log ratios of how often a tag or container
occurs inside and outside the article element of labelled pages.

Results on unusual rows: a null or empty page, or one without content words,
gives "" and 0; a page cut off in a tag, comment or script ends there; equal pages get equal
rows; null ids or urls are carried along; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that the weights are fitted on, about, and most features kept.
LABELLED, FEATURES = 2_000, 2_000

# Elements that open a block of their own.
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript object ol optgroup option p pre section select summary"
    " svg table tbody td textarea tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style template noscript svg iframe object textarea title math canvas audio video".split())
# Elements, and words in class, id and role attributes, of what isn't the article.
_OUTSIDE = frozenset("head nav footer aside form menu dialog button select option optgroup fieldset legend frameset dir".split())
_OUTSIDE_NAMES = frozenset(
    "ad ads adv advert advertisement adverts advertising sponsor sponsored promo promotion cookie cookies consent gdpr"
    " popup modal overlay nav navbar navigation breadcrumb breadcrumbs sidebar aside widget widgets footer comments disqus"
    " subscribe subscription newsletter signup login pagination pager toolbar contentinfo complementary masthead".split()
)
# Ordinary words that tell the same if a name has no other words than these and the following.
_DOUBTFUL_NAMES = frozenset("banner notice notices alert warning menu rail comment reply replies respond discussion related recommended share sharing social search skip".split())
_FRAME_NAMES = frozenset("area bar block body box button buttons col column container content feed form group header icons inner item items link links list news outer page panel post posts row section site stories text thread title top bottom left right wrap wrapper".split())
_INSIDE_NAMES = frozenset("article content post entry main story text".split())
_LOOSE_NAMES = frozenset("header topbar top bottom".split())

# A quote opens a value only behind an equals sign and if it is closed; so each tag ends at its first ">" outside values.
_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)(?:>|\Z)|[^<]+|<""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


def tells_outside(names: list[str]) -> bool:
    """Whether class, id or role names are those of what isn't the article."""
    for name in names:
        parts = set(filter(None, _PARTS.split(name)))
        if parts & _OUTSIDE_NAMES or (parts & _DOUBTFUL_NAMES and all(x in _DOUBTFUL_NAMES or x in _FRAME_NAMES or x.isdigit() for x in parts)):
            return True
    return False


class Page:
    """Blocks of a page and the elements that hold them.

    Elements are numbered as they open, so those within an element are the numbers from its
    own to ``last``.
    """

    def __init__(self, source: str, weights: dict[str, float]):
        self.blocks: list[str] = []
        self.features: list[Counter[str]] = []  # tags since the block before
        self.holders: list[int] = []  # the innermost element of each block
        self.names: list[str] = ["#page"]
        self.keys: list[tuple[str, ...]] = [()]
        self.parents: list[int] = [0]
        self.last: list[int] = [0]
        self.outside: list[bool] = [False]
        self.inside: list[bool] = [False]  # in or at an article or main element
        self._weights = weights
        self._stack = [0]
        self._open_names: Counter[str] = Counter()
        self._text: list[str] = []
        self._tags: Counter[str] = Counter()
        self._read(source)
        while self._stack:
            self._close()

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            self._text = []
            if text:
                self.blocks.append(text)
                self.features.append(self._tags)
                self.holders.append(self._stack[-1])
                self._tags = Counter()

    def _close(self) -> str:
        element = self._stack.pop()
        self.last[element] = len(self.names) - 1
        self._open_names[self.names[element]] -= 1
        return self.names[element]

    def _open(self, name: str, attributes: str) -> None:
        names = [word for found in _NAMES.finditer(attributes) for word in (found[1] or found[2] or found[3] or "").lower().split()] if attributes else []
        words = {part for word in names for part in _PARTS.split(word) if part}
        keys = (name, *(f"{name}.{word}" for word in sorted(words)))
        parent = self._stack[-1]
        out = name in _OUTSIDE or tells_outside(names) or (not self.inside[parent] and (name == "header" or bool(words & _LOOSE_NAMES) and not words & _INSIDE_NAMES))
        if name not in ("article", "main", "body", "html"):
            # A bare element name tells too little: only names that the page gave are learned.
            out = out or any(self._weights.get(f"in {key}", 0.0) < -2 for key in keys[1:])
        elif name != "article" or not words & {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "sponsored", "promo"}:
            out = False
        self._stack.append(len(self.names))
        self._open_names[name] += 1
        self.names.append(name)
        self.keys.append(keys)
        self.parents.append(parent)
        self.last.append(0)
        self.outside.append(self.outside[parent] or out)
        self.inside.append(self.inside[parent] or name in ("article", "main"))

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            token = _TOKEN.match(source, at)
            at = token.end()
            name = token[2]
            if name is None:
                part = token[0]
                if part[0] != "<" or part == "<":
                    self._text.append(part)
                continue
            name = name.lower()
            closing = token[1] == "/"
            if name in _RAW and not closing and not token[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                at = close.end() if close else end
                if name in _BLOCKS:
                    self._flush()
                continue
            self._tags["/" + name if closing else name] += 1
            if name not in _BLOCKS:
                if name in ("br", "td", "th"):
                    self._text.append(" ")
                continue
            self._flush()
            if closing:
                if self._open_names[name]:
                    while self._close() != name:
                        pass
            elif name not in _VOID:
                # These end by themselves where the next one begins.
                while self.names[self._stack[-1]] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                    self._close()
                if name in ("li", "dt", "dd", "option", "tr") and self.names[self._stack[-1]] == name:
                    self._close()
                self._open(name, token[3])
        self._flush()


def region(page: Page, weights: dict[str, float]) -> list[str]:
    """The blocks of the content region."""
    best, best_span, total, start = 0.0, None, 0.0, 0
    for at, text in enumerate(page.blocks):
        penalty = sum(weights.get(tag, -0.3) * n for tag, n in page.features[at].items())
        total += penalty
        if total <= 0:
            total, start = 0.0, at
        words = text.count(" ") + 1
        total += -2.0 * words if page.outside[page.holders[at]] else words
        if total > best:
            best, best_span = total, (start, at + 1)
    if best_span is None:
        return []
    first, last = best_span
    inside = [i for i in range(first, last) if not page.outside[page.holders[i]]]
    low, high = min(page.holders[i] for i in inside), max(page.holders[i] for i in inside)
    holder = low
    while page.last[holder] < high:
        holder = page.parents[holder]
    above = holder  # the outermost article or main element around the run
    while above:
        holder = above if page.names[above] in ("article", "main") else holder
        above = page.parents[above]
    if page.names[holder] in ("#page", "html", "body"):
        chosen = inside
    else:
        chosen = [i for i, own in enumerate(page.holders) if holder <= own <= page.last[holder] and not page.outside[own]]
    return [page.blocks[i] for i in chosen]


def main_text(source: str | None, weights: dict[str, float]) -> str:
    """The main text of one page."""
    return "\n\n".join(region(Page(source or "", weights), weights))


def label_counts(source: str) -> Counter[tuple[str, bool]]:
    """Tags and containers, and whether they are inside the page's article element."""
    counts: Counter[tuple[str, bool]] = Counter()
    page = Page(source, {})
    below = [False] * len(page.names)  # strictly within an article element
    for element in range(1, len(page.names)):
        parent = page.parents[element]
        below[element] = below[parent] or page.names[parent] == "article"
    within = [below[i] or name == "article" for i, name in enumerate(page.names)]
    words = [0] * len(page.names)
    for text, tags, holder in zip(page.blocks, page.features, page.holders, strict=True):
        words[holder] += text.count(" ") + 1
        for tag, n in tags.items():
            counts[tag, within[holder]] += n
    for element in range(len(page.names) - 1, 0, -1):
        # A container within the article counts as inside, one without as outside for its words that no article holds.
        if page.names[element] != "article" or below[element]:
            for key in page.keys[element]:
                counts[f"in {key}", below[element]] += words[element]
            words[page.parents[element]] += words[element] if within[page.parents[element]] or not within[element] else 0
    return counts


def fit_weights(pages: DataFrame) -> dict[str, float]:
    """Weights from about LABELLED pages that have an article element, chosen by hash.

    The share to choose follows from their number, so no page leaves its task.
    """
    labelled = pages.where(F.contains(F.lower("html"), F.lit("<article")))
    share = min(1.0, LABELLED / max(1, labelled.count()))
    chosen = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(1 << 30)) < math.ceil(share * (1 << 30))
    labelled = labelled.where(chosen).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, bool]] = Counter()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                counts.update(label_counts(source))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in counts], pa.string()), pa.array([n if inside else 0 for (_, inside), n in counts.items()], pa.int64()), pa.array([0 if inside else n for (_, inside), n in counts.items()], pa.int64())],
            ["feature", "inside", "outside"],
        )

    counted = labelled.mapInArrow(run, "feature string, inside long, outside long").groupBy("feature").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    rows = counted.orderBy(F.desc(F.col("i") + F.col("o")), "feature").limit(FEATURES).collect()
    weights = {}
    for feature, inside, outside in rows:
        odds = math.log((inside + 1) / (outside + 1))
        weights[feature] = odds if feature.startswith("in ") else max(min(odds, -0.1), -4.0)
    return weights


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    source = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].cast("string").alias("html"))
    weights = fit_weights(source)
    schema = f"page_id {source.schema['page_id'].dataType.simpleString()}, url {source.schema['url'].dataType.simpleString()}, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py(), weights) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, schema)
