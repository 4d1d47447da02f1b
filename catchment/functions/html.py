"""Landed web pages to rows. Only tokenising is Python; every rule after it is a column expression."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADINGS = {"h1", "h2"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Texts(HTMLParser):
    """Text pieces inside the elements between a matching h2 and the next h1 or h2 beside it."""

    def __init__(self, heading: str):
        super().__init__(convert_charrefs=True)
        self.wanted = re.compile(heading, re.IGNORECASE)
        self.open: list[str] = []
        self.title: list[str] | None = None
        self.level: int | None = None
        self.done = False
        self.pieces: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _VOID:
            return
        if self.level == len(self.open) and tag in HEADINGS:
            self.done = True
        if self.level is None and tag == "h2":
            self.title = []
        self.open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.open:
            return
        while self.open.pop() != tag:
            pass
        if self.title is not None and tag == "h2":
            if self.wanted.search("".join(self.title)):
                self.level = len(self.open)
            self.title = None
        elif self.level is not None and len(self.open) < self.level:
            self.done = True

    def handle_data(self, data: str) -> None:
        if self.title is not None:
            self.title.append(data)
        elif self.level is not None and not self.done and len(self.open) > self.level and data.strip():
            self.pieces.append(data.strip())


class _Table(HTMLParser):
    """Head cells and body rows of the first table of a class."""

    def __init__(self, table_class: str):
        super().__init__(convert_charrefs=True)
        self.table_class = table_class
        self.inside = 0
        self.done = False
        self.section = ""
        self.head: list[str] = []
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            classes = (dict(attrs).get("class") or "").split()
            if self.inside or (not self.done and self.table_class in classes):
                self.inside += 1
        elif self.inside:
            if tag in ("thead", "tbody"):
                self.section = tag
            elif tag == "tr" and self.section == "tbody":
                self.rows.append([])
            elif (tag == "th" and self.section == "thead") or (tag == "td" and self.section == "tbody" and self.rows):
                self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.inside:
            self.inside -= 1
            self.done = self.inside == 0
        elif tag in ("th", "td") and self.cell is not None:
            text = "".join(self.cell)
            if tag == "th":
                self.head.append(text)
            else:
                self.rows[-1].append(text)
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data.strip())


class _Items(HTMLParser):
    """Texts of list items, in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[str] = []
        self.open = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "li":
            self.open += 1
            self.items.append("")

    def handle_endtag(self, tag: str) -> None:
        if tag == "li" and self.open:
            self.open -= 1

    def handle_data(self, data: str) -> None:
        if self.open:
            self.items[-1] += data


def _fed(parser: HTMLParser, html: str) -> HTMLParser:
    parser.feed(html)
    parser.close()
    return parser


def _parsed(pages: DataFrame, column: str, out: dict[str, str], work: Callable[[str], dict]) -> DataFrame:
    """Pages in, the same rows with parsed columns in place of the page; streamed batch by batch."""
    kept = [f for f in pages.schema if f.name != column]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in out.items()])
    names = [f.name for f in kept]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parsed = [work(html) if html is not None else {} for html in frame[column]]
            result = frame[names].copy()
            for name in out:
                result[name] = [row.get(name) for row in parsed]
            yield result

    return pages.mapInPandas(batches, schema)


def section_texts(pages: DataFrame, headings: dict[str, str], column: str = "html") -> DataFrame:
    """Each page with, per output name, the text pieces after the heading that matches, and ``parse_error``."""

    def work(html: str) -> dict:
        try:
            row = {name: _fed(_Texts(pattern), html).pieces for name, pattern in headings.items()}
        except Exception as error:
            return {"parse_error": type(error).__name__, "parse_message": str(error)}
        return row

    out = {**{name: "array<string>" for name in headings}, "parse_error": "string", "parse_message": "string"}
    return _parsed(pages, column, out, work)


def label_values(pieces: Column) -> Column:
    """Text pieces as a map of ``key: value``; pieces without a colon carry on the value before them."""

    def take(state: Column, piece: Column) -> Column:
        colon = F.instr(piece, ":")
        key = F.when(colon > 0, F.trim(F.substring(piece, F.lit(1), colon - 1))).otherwise(state["key"])
        rest = F.trim(F.substring(piece, colon + 1, F.length(piece)))
        old = F.coalesce(F.try_element_at(state["found"], key), F.lit(""))
        value = F.when(colon > 0, F.when(rest != "", rest).otherwise(old)).when(
            state["key"] != "", F.trim(F.concat(old, F.lit(" "), piece))
        )
        others = F.map_filter(state["found"], lambda k, _: k != key)
        found = F.when(value.isNull(), state["found"]).otherwise(F.map_concat(others, F.map_from_arrays(F.array(key), F.array(value))))
        return F.struct(key.alias("key"), found.alias("found"))

    empty = F.struct(F.lit("").alias("key"), F.create_map().cast("map<string,string>").alias("found"))
    found = F.aggregate(pieces, empty, take)["found"]
    return F.transform_values(found, lambda _, v: F.trim(F.regexp_replace(v, r"\s+", " ")))


def table_rows(pages: DataFrame, table_class: str, column: str = "html") -> DataFrame:
    """One map of head cell to body cell per body row as wide as the head; pages without the table give none."""

    def work(html: str) -> dict:
        table = _fed(_Table(table_class), html)
        return {"rows": [dict(zip(table.head, row)) for row in table.rows if len(row) == len(table.head)]}

    parsed = _parsed(pages, column, {"rows": "array<map<string,string>>"}, work)
    return parsed.select(*[c for c in parsed.columns if c != "rows"], F.explode("rows").alias("row"))


def list_items(pages: DataFrame, column: str = "html") -> DataFrame:
    """One row per list item with its place from one."""

    def work(html: str) -> dict:
        return {"items": [item.strip() for item in _fed(_Items(), html).items]}

    parsed = _parsed(pages, column, {"items": "array<string>"}, work)
    return parsed.select(
        *[c for c in parsed.columns if c != "items"], F.posexplode("items").alias("place", "item")
    ).withColumn("place", F.col("place") + 1)
