"""Functions that need Python: HTML paragraphs and main text, Unicode normalisation. All run on Arrow batches."""

from __future__ import annotations

import html
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_DROPPED = {"script", "style", "noscript", "header", "footer", "nav", "aside", "form", "svg"}
_DROPPED_HINTS = ("cookie", "advert", "promo", "sidebar", "newsletter", "share", "related")
_VOID = {"br", "img", "hr", "input", "meta", "link"}


class _Paragraphs(HTMLParser):
    """Texts of paragraphs; a new paragraph closes an open one, as browsers do."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[str] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self.found.append("")
            self.open = True

    def handle_endtag(self, tag):
        if tag in ("p", "body", "div", "article"):
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.found[-1] += data


class _Main(HTMLParser):
    """Text of blocks outside page furniture with at least a number of words."""

    def __init__(self, least: int) -> None:
        super().__init__(convert_charrefs=True)
        self.least, self.hidden, self.stack, self.blocks = least, 0, [], [""]

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        hint = " ".join(v or "" for k, v in attrs if k in ("class", "id")).lower()
        hide = tag in _DROPPED or any(h in hint for h in _DROPPED_HINTS)
        self.stack.append((tag, hide))
        self.hidden += hide
        if tag in ("p", "div", "li", "section", "article", "td", "h1", "h2", "h3"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.hidden -= sum(h for _, h in self.stack[i:])
                del self.stack[i:]
                break

    def handle_data(self, data):
        if not self.hidden:
            self.blocks[-1] += data


class _Rows(HTMLParser):
    """Texts of the cells of each table row."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
            self.open = False
        elif tag == "td" and self.rows:
            self.rows[-1].append("")
            self.open = True

    def handle_endtag(self, tag):
        if tag in ("td", "tr", "table"):
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.rows[-1][-1] += data


def table_rows_of(page: str | None) -> list[list[str]] | None:
    """Cells of the rows of all tables of a page, header rows left out; null for null."""
    if page is None:
        return None
    p = _Rows()
    p.feed(page)
    p.close()
    return [[" ".join(c.split()) for c in r] for r in p.rows if r]


def paragraphs_of(page: str | None) -> str | None:
    """All paragraph texts joined by spaces; null for null."""
    if page is None:
        return None
    p = _Paragraphs()
    p.feed(page)
    p.close()
    return " ".join(" ".join(html.unescape(x).replace("\xa0", " ").split()) for x in p.found if x.strip())


def main_text_of(page: str | None, least: int = 25) -> str | None:
    if page is None:
        return None
    p = _Main(least)
    p.feed(page)
    p.close()
    return "\n".join(" ".join(b.split()) for b in p.blocks if len(b.split()) >= least)


@F.pandas_udf(StringType())
def paragraphs(pages: pd.Series) -> pd.Series:
    return pages.map(paragraphs_of)


@F.pandas_udf(StringType())
def main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text_of)


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).strip())


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def table_rows(pages: pd.Series) -> pd.Series:
    return pages.map(table_rows_of)
