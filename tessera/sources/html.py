"""Headings of HTML pages held in a string column (no network fetch).

Pages are read by Python's HTML parser in Arrow batches, which knows comments,
scripts, any quoting, nesting and all character references.  A heading that
holds a link gives the link text, otherwise its first text child; newlines of
a link text become blanks and the result is stripped.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Open:
    """A heading whose end has not been read yet."""

    def __init__(self, place: int, tag: str):
        self.place, self.tag, self.depth = place, tag, 1
        self.first, self.children = "", False
        self.link, self.in_link = None, False


class HeadingParser(HTMLParser):
    """Texts of the closed elements of one tag or one class, in the order of
    their beginnings."""

    def __init__(self, tag: str | None, css_class: str | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class = tag, css_class
        self.open: list[_Open] = []
        self.found: list[str | None] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        for h in self.open:
            h.children = True
            h.depth += tag == h.tag
            if tag == "a" and h.link is None:
                h.link, h.in_link = "", True
        if tag == self.tag if self.tag else self.css_class in (dict(attrs).get("class") or "").split():
            self.open.append(_Open(len(self.found), tag))
            self.found.append(None)

    def handle_endtag(self, tag: str) -> None:
        for h in self.open:
            if tag == "a":
                h.in_link = False
            h.depth -= tag == h.tag
            if h.depth == 0:
                text = h.first if h.link is None else h.link.replace("\n", " ")
                self.found[h.place] = text.strip()
        self.open = [h for h in self.open if h.depth]

    def handle_data(self, data: str) -> None:
        for h in self.open:
            if h.in_link:
                h.link += data
            if not h.children:
                h.first += data


def heading_texts(page: str, tag: str | None = None, css_class: str | None = None) -> list[str]:
    """Heading texts of one page; elements that never end are left out."""
    parser = HeadingParser(tag, css_class)
    parser.feed(page)
    parser.close()
    return [t for t in parser.found if t is not None]


def headings(df: DataFrame, html_col: str, keys: list[str], tag: str | None = "h1",
             css_class: str | None = None, out: str = "heading") -> DataFrame:
    """``keys + [heading_no, heading]``; a page without a heading (or without
    text) keeps one row with NULLs (a miss is reported, not dropped).

    The JVM looks at each page first: the text of one without the tag and its end (or
    without the class name) never reaches Python.
    """
    if css_class is not None:
        tag = None
    elif tag is None:
        raise ValueError("give a tag or a css_class")
    page = F.col(html_col)
    if tag is not None:
        name = re.escape(tag)
        page = F.when(page.rlike(rf"(?i)<{name}\b") & page.rlike(rf"(?i)</{name}\b"), page)
    else:
        page = F.when(F.contains(page, F.lit(css_class)) | F.contains(page, F.lit("&")), page)
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("_found", T.ArrayType(T.StringType()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [heading_texts(p, tag, css_class) if p else [] for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.string()))], names=names)

    parsed = df.select(*keys, page.alias("_page")).mapInArrow(run, schema)
    exploded = parsed.select(*keys, F.posexplode_outer("_found").alias("_pos", out))
    return exploded.select(*keys, (F.col("_pos") + 1).cast("bigint").alias("heading_no"), out)


# Used inside Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
