"""HTML sections: a title and the visible text, by the standard library's parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that break blocks, and elements whose text isn't shown.
BREAKS = frozenset("address article aside blockquote br dd div dl dt figcaption figure footer h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
HIDDEN = frozenset("head script style template noscript svg math".split())
HEADINGS = ("h1", "h2", "h3")


class _Section(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0
        self.title, self.heading = "", ""
        self._in: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._in.append(tag)
        self.hidden += tag in HIDDEN
        if tag in BREAKS:
            self.parts.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in self._in:
            while self._in:
                closed = self._in.pop()
                self.hidden -= closed in HIDDEN
                if closed == tag:
                    break
        if tag in BREAKS:
            self.parts.append("\n")

    def handle_data(self, data: str) -> None:
        if "title" in self._in:
            self.title += data
        if self.hidden:
            return
        if any(tag in HEADINGS for tag in self._in) and "\n" not in self.heading:
            self.heading += data
        self.parts.append(data)


def section(source: str | None, toc_title: str | None, order: int) -> tuple[str, str]:
    """Title (heading, table of contents, document title or a made one) and text without a repeated title line."""
    parser = _Section()
    parser.feed(source or "")
    parser.close()
    lines = [" ".join(line.split()) for line in "".join(parser.parts).split("\n")]
    lines = [line for line in lines if line]
    title = next((t for t in (" ".join(x.split()) for x in (parser.heading, toc_title or "", parser.title)) if t), f"Section {order}")
    if lines and lines[0] == title:
        lines = lines[1:]
    return title, "\n".join(lines)


def sections(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, title, text of each page."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [section(html, None, int(key)) for key, html in zip(frame["id"], frame["html"], strict=True)]
            yield pd.DataFrame({"id": frame["id"], "title": [t for t, _ in made], "text": [x for _, x in made]})

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInPandas(run, "id long, title string, text string")
