"""Text, HTML and CSV sources, and pages."""

from __future__ import annotations

import csv
import io
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_CHARS = 3000


class _Data(HTMLParser):
    """Gathers character data; ``visible`` leaves out what a browser wouldn't show."""

    HIDDEN = ("script", "style", "head", "title", "template", "noscript")

    def __init__(self, visible: bool):
        super().__init__()
        self.parts: list[str] = []
        self.visible, self.depth = visible, 0

    def handle_starttag(self, tag, attrs):
        self.depth += self.visible and tag in self.HIDDEN

    def handle_endtag(self, tag):
        if self.visible and tag in self.HIDDEN and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def strip_html(html: str, visible: bool = False) -> str:
    """All character data joined by spaces (script and style included unless ``visible``); what
    stands in a tag that is still open at the end is lost, as the parser isn't closed."""
    parser = _Data(visible)
    parser.feed(html)
    return " ".join(parser.parts)


def csv_to_text(text: str) -> str:
    return "\n".join(", ".join(row) for row in csv.reader(io.StringIO(text)))


def html_text(html: Column, visible: bool = False) -> Column:
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else strip_html(v, visible))

    return run(html)


def csv_text(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else csv_to_text(v))

    return run(text)


def decode(content: Column) -> Column:
    """UTF-8 with replacement characters for what isn't."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else bytes(v).decode("utf-8", errors="replace"))

    return F.coalesce(F.try_validate_utf8(content.cast("string")), run(F.when(F.try_validate_utf8(content.cast("string")).isNull(), content)))


def file_text(content: Column, path: Column) -> Column:
    """The text of a file of the text reader: HTML and CSV are converted, others are as they are."""
    from quire.sources.routing import suffix

    text, s = decode(content), suffix(path)
    return F.when(s.isin(".html", ".htm"), html_text(F.when(s.isin(".html", ".htm"), text))).when(s == ".csv", csv_text(F.when(s == ".csv", text))).otherwise(text)


def paginate(docs: DataFrame, text: str = "text", page_chars: int = PAGE_CHARS) -> DataFrame:
    """A row for each slice of ``page_chars`` characters, numbered from 1; an empty text is one empty page.

    All other columns stay. One pass without a shuffle: a document's pages come from its row.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    starts = F.sequence(F.lit(0), F.greatest(F.length(whole) - 1, F.lit(0)), F.lit(page_chars))
    pages = F.transform(starts, lambda i: F.substring(whole, i + 1, F.lit(page_chars)))
    others = [c for c in docs.columns if c != text]
    return docs.select(*others, F.posexplode(pages).alias("__page", "native_text")).select(*others, (F.col("__page") + 1).alias("page_number"), "native_text")
