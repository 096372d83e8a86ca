"""Tables and elements of HTML pages."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Executors get the parser with the task and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLE_ROWS_SCHEMA = "table_idx int, row_idx int, is_header boolean, cells array<string>"

ROWS_PER_BATCH = 20_000
ROW_GROUPS = ("thead", "tbody", "tfoot")

LINK_PATTERN = r'(?is)<a\s[^>]*?href="([^"]*)"'
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"


class _TableReader(HTMLParser):
    """Collects (table, row, header?, cells). Nested tables are numbered in order of opening.

    A cell that spans columns or rows is repeated in each of them, so that the rows of a table
    line up; a row span ends with its row group. Header rows are those of ``thead``, or without
    one the leading rows that hold ``th`` cells only.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, bool, list[str]]] = []
        self.tables = 0
        self.stack: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.stack.append(
                {
                    "table": self.tables, "row": None, "cell": None, "span": (1, 1), "th": True,
                    "held": {}, "in_head": False, "rows": [],
                }
            )
            self.tables += 1
        elif self.stack and tag in ROW_GROUPS:
            self._end_group()
            self.stack[-1]["in_head"] = tag == "thead"
        elif self.stack and tag == "tr":
            self._end_row()
            self.stack[-1].update(row=[], th=True)
        elif self.stack and tag in ("td", "th"):
            top = self.stack[-1]
            if top["row"] is None:
                top.update(row=[], th=True)
            self._end_cell()
            top["cell"] = []
            top["span"] = (_column_span(attrs), _row_span(attrs))
            top["th"] = top["th"] and tag == "th"

    def handle_endtag(self, tag):
        if not self.stack:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag in ROW_GROUPS:
            self._end_group()
        elif tag == "table":
            self._end_group()
            self._number(self.stack.pop())

    def handle_data(self, data):
        if self.stack and self.stack[-1]["cell"] is not None:
            self.stack[-1]["cell"].append(data)

    def _end_cell(self):
        top = self.stack[-1]
        if top["cell"] is not None:
            top["row"].append((" ".join("".join(top["cell"]).split()), *top["span"]))
            top["cell"] = None

    def _end_row(self):
        top = self.stack[-1]
        self._end_cell()
        if top["row"]:
            top["rows"].append((top["in_head"], top["th"], self._spread(top)))
        top["row"] = None

    def _end_group(self):
        """No cell reaches beyond its row group."""
        self._end_row()
        self.stack[-1].update(held={}, in_head=False)

    def _number(self, table: dict):
        """Rows of a closed table, now that it is known whether it has a head."""
        headed = any(in_head for in_head, _, _ in table["rows"])
        leading = True
        for number, (in_head, only_th, cells) in enumerate(table["rows"]):
            leading = leading and only_th
            self.rows.append((table["table"], number, in_head if headed else leading, cells))

    @staticmethod
    def _spread(top: dict) -> list[str]:
        """The cells of the current row with spans filled in; ``held`` are cells from rows above."""
        held, kept, cells = top["held"], {}, []

        def place(text: str, rows_left: int) -> None:
            if rows_left:
                kept[len(cells)] = (text, rows_left)
            cells.append(text)

        for text, columns, rows in top["row"]:
            for _ in range(columns):
                while len(cells) in held:
                    above, left = held.pop(len(cells))
                    place(above, left - 1)
                place(text, rows - 1)
        for column in sorted(held):
            above, left = held[column]
            place(above, left - 1)
        top["held"] = kept
        return cells


def _number(attrs: list[tuple[str, str | None]], name: str) -> int | None:
    value = dict(attrs).get(name) or ""
    return int(value) if value.isascii() and value.isdigit() else None


def _column_span(attrs: list[tuple[str, str | None]]) -> int:
    """Within the limits of HTML, which are 1 and 1000; anything else counts as 1."""
    return min(max(_number(attrs, "colspan") or 1, 1), 1000)


def _row_span(attrs: list[tuple[str, str | None]]) -> int:
    """At most HTML's 65534; 0 reaches to the end of the row group, anything else counts as 1."""
    value = _number(attrs, "rowspan")
    return 65534 if value == 0 else min(value or 1, 65534)


def table_rows(html: str | None) -> list[tuple[int, int, bool, list[str]]]:
    reader = _TableReader()
    reader.feed(html or "")
    reader.close()
    while reader.stack:
        reader.handle_endtag("table")
    return sorted(reader.rows, key=lambda row: row[:2])


def extract_html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """One row per table row: ``key, table_idx, row_idx, is_header, cells``.

    A Python function, because HTML has no built-in reader. It is a
    narrow map over Arrow batches, one page at a time and without a shuffle, and pages without
    a table never reach it. For very large pages lower
    ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    columns = [key, "table_idx", "row_idx", "is_header", "cells"]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, text in zip(batch[key], batch[html]):
                out += [(page, *row) for row in table_rows(text)]
                if len(out) >= ROWS_PER_BATCH:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    key_type = pages.schema[key].dataType.simpleString()
    with_table = pages.select(key, html).filter(F.col(html).rlike("(?i)<table"))
    return with_table.mapInPandas(parse, f"`{key}` {key_type}, {TABLE_ROWS_SCHEMA}")


def pick_table(rows: DataFrame, index: int, names: list[str]) -> DataFrame:
    """Body rows of table ``index`` with its cells as text columns."""
    key = rows.columns[0]
    return rows.filter((F.col("table_idx") == index) & ~F.col("is_header")).select(
        key, "row_idx", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )


def link_targets(html: Column | str) -> Column:
    return F.regexp_extract_all(html, F.lit(LINK_PATTERN), F.lit(1))


def page_title(html: Column | str) -> Column:
    return F.regexp_extract(html, TITLE_PATTERN, 1)
