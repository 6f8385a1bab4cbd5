"""All tables of stored HTML as grids: nested tables, spanning cells, cells that are never closed."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# comments and scripts are skipped, then come tags and text
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)(\w+)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|([^<]+|<)", re.S | re.I)
_NAMED = r"(?i)\b%s\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_CLASS, _COLSPAN, _ROWSPAN = (re.compile(_NAMED % name) for name in ("class", "colspan", "rowspan"))
#: The largest spans that HTML allows.
WIDEST, TALLEST = 1000, 65534


def _attribute(pattern: re.Pattern, tag: str) -> str:
    found = pattern.search(tag)
    return next((g for g in found.groups() if g is not None), "") if found else ""


def _span(pattern: re.Pattern, tag: str, most: int) -> int:
    text = _attribute(pattern, tag).strip()
    return min(int(text), most) if text.isascii() and text.isdigit() else 1


class _Table:
    """A table that is being read; it is on the stack until its end tag or the end of the page."""

    def __init__(self, depth: int, css_class: str):
        self.depth, self.css_class = depth, css_class
        self.rows: list[list[tuple[list[str], int, int, bool]]] = []
        self.row = self.text = None

    def open_row(self) -> None:
        self.text, self.row = None, []
        self.rows.append(self.row)

    def open_cell(self, tag: str, head: bool) -> None:
        if self.row is None:
            self.open_row()
        self.text = []
        self.row.append((self.text, max(1, _span(_COLSPAN, tag, WIDEST)), _span(_ROWSPAN, tag, TALLEST), head))

    def grid(self) -> Iterator[tuple[bool, list[str]]]:
        """(all cells are header cells, texts) of each row, every spanning cell written at all its places."""
        reach: dict[int, tuple[int, str, bool]] = {}  # column -> rows still covered from above
        for at, row in enumerate(self.rows):
            out, rest = {c: (text, head) for c, (_, text, head) in reach.items()}, {c: (n - 1, t, h) for c, (n, t, h) in reach.items() if n > 1}
            col = 0
            for parts, wide, tall, head in row:
                text = " ".join("".join(parts).split())
                while col in out:
                    col += 1
                tall = tall or len(self.rows) - at  # 0 reaches to the last row
                for c in range(col, col + wide):
                    if c in out:  # a cell from above ends the span
                        break
                    out[c] = text, head
                    if tall > 1:
                        rest[c] = tall - 1, text, head
                    col = c + 1
            reach = rest
            width = max(out, default=-1) + 1
            yield bool(out) and all(h for _, h in out.values()), [out[c][0] if c in out else "" for c in range(width)]


def read_tables(page: str) -> list[_Table]:
    """Tables of a page in the order of their start tags; one pass with a stack of open tables.

    Text counts for the open cell of every table on the stack, so a cell holds
    the text of tables inside it. Row and cell tags belong to the innermost
    table; a cell ends where the next cell, row or section begins.
    """
    found: list[_Table] = []
    stack: list[_Table] = []
    for m in _TOKEN.finditer(page):
        _, slash, name, tag, text = m.groups()
        if text is not None:
            for t in stack:
                if t.text is not None:
                    t.text.append(entities.unescape(text))
            continue
        name = (name or "").lower()
        if name == "table":
            if not slash:
                stack.append(_Table(len(stack), _attribute(_CLASS, tag)))
                found.append(stack[-1])
            elif stack:
                stack.pop()
        elif stack:
            top = stack[-1]
            if name in ("td", "th"):
                if slash:
                    top.text = None
                else:
                    top.open_cell(tag, name == "th")
            elif name == "tr" and not slash:
                top.open_row()
            elif name in ("tr", "thead", "tbody", "tfoot", "caption"):
                top.text = top.row = None
            elif name in ("br", "p", "div", "li"):
                for t in stack:
                    if t.text is not None:
                        t.text.append(" ")
    return found


def html_grids(pages: DataFrame, keys: Sequence[str] = ("page_id",), html: str = "html") -> DataFrame:
    """A row for each row of each table: keys, ``table_pos``, ``depth``, ``css_class``, ``row_pos``, ``is_header``, ``cells``.

    Tables are numbered in the order of their start tags, ``depth`` is 0 for one
    that is not in another. Spanning cells are repeated at all their places, a
    rowspan ends with its table, a colspan at a cell from above. Places that no
    cell covers are ''. White space is collapsed and entities are decoded. A null page and a page without
    tables have no rows. Pages are projected one by one: nothing is shuffled,
    and a task holds one batch of pages.
    """
    names = ["table_pos", "depth", "css_class", "row_pos", "is_header", "cells"]
    types = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.string())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                out, source = [[] for _ in names], []
                for i, page in enumerate(batch.column(len(keys)).slice(lo, 64).to_pylist(), lo):
                    for pos, t in enumerate(read_tables(page or "")):
                        for r, (head, cells) in enumerate(t.grid()):
                            source.append(i)
                            for c, v in zip(out, (pos, t.depth, t.css_class, r, head, cells)):
                                c.append(v)
                if source:
                    own = [batch.column(i).take(pa.array(source)) for i in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(out, types))], [*keys, *names])

    source = pages.select(*keys, html)
    found = StructType.fromDDL("table_pos int, depth int, css_class string, row_pos int, is_header boolean, cells array<string>")
    return source.mapInArrow(rows, StructType(source.schema.fields[:-1] + found.fields))
