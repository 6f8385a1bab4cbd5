"""Tables and lists out of stored HTML, by array expressions on the page row.

A page stays one row until its table rows are exploded; cells are picked by
position from the cell array, so no shuffle and no pivot is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
_TAG = r"(?s)<[^>]*>"


def _all(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def inner_text(c: Column) -> Column:
    """Text of a fragment: tags removed, the five basic entities decoded."""
    text = F.regexp_replace(c, _TAG, "")
    # Entity -> character; the ampersand must come last.
    for entity, char in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")]:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _pick(blocks: Column, nth: int) -> Column:
    """n-th element from the front (0, 1, ..) or from the back (-1, ..); null if absent."""
    return F.try_element_at(blocks, F.lit(nth + 1 if nth >= 0 else nth))


def _cells(row: Column, cell_tags: Sequence[str]) -> Column:
    tags = "|".join(cell_tags)
    raw = _all(row, rf"(?is)<(?:{tags})\b[^>]*>(.*?)</(?:{tags})\s*>")
    return F.transform(raw, inner_text)


def extract_html_table(
    pages: DataFrame,
    keys: Sequence[str] = ("page_id",),
    html: str = "html",
    row_tag: str = "tr",
    cell_tags: Sequence[str] = ("th", "td"),
    css_class: str | None = None,
    nth: int | None = None,
    head: int = 0,
    tail: int = 0,
) -> DataFrame:
    """Rows of one table per page: ``row_pos``, ``header`` and ``cells`` arrays.

    With ``css_class`` the n-th table of that class is read (first by default).
    Otherwise the header is the last ``thead`` of the page and the rows are
    those of the first ``tbody``. ``head`` and ``tail`` rows are cut before the
    rows are exploded.
    """
    row = _ROW if row_tag == "tr" else rf"(?is)<{row_tag}\b[^>]*>(.*?)</{row_tag}\s*>"
    doc = F.col(html)
    if css_class is not None:
        table = _pick(
            _all(doc, rf"(?is)<table\b[^>]*class=[\"'][^\"']*\b{css_class}\b[^\"']*[\"'][^>]*>(.*?)</table\s*>"),
            nth or 0,
        )
        # the rows are a column first: written out in the header and in the body, they would be searched for in each
        pages = pages.select(*keys, _all(table, row).alias("_rows"))
        header = _cells(F.try_element_at("_rows", F.lit(1)), cell_tags)
        body = F.slice("_rows", F.lit(2), F.greatest(F.size("_rows") - 1, F.lit(0)))
    else:
        header = _cells(_pick(_all(doc, r"(?is)<thead\b[^>]*>(.*?)</thead\s*>"), -1), cell_tags)
        body = _all(_pick(_all(doc, r"(?is)<tbody\b[^>]*>(.*?)</tbody\s*>"), nth or 0), row)
    read = trim_rows(pages.select(*keys, header.alias("header"), body.alias("_rows")), "_rows", head, tail)
    # before a plain explode Spark filters pages by the size of their rows, and searches each page again to do so
    exploded = read.select(*keys, "header", F.posexplode_outer("_rows").alias("row_pos", "_row")).filter("row_pos is not null")
    return exploded.select(*keys, "row_pos", "header", _cells(F.col("_row"), cell_tags).alias("cells"))


def trim_rows(df: DataFrame, col: str, head: int = 0, tail: int = 0) -> DataFrame:
    """Cut the first ``head`` and last ``tail`` elements of a row array."""
    if not head and not tail:
        return df
    length = F.greatest(F.size(col) - F.lit(head + tail), F.lit(0))
    return df.withColumn(col, F.slice(F.col(col), F.lit(head + 1), length))


def cell(name: str) -> Column:
    """Cell under the header ``name``; null when the table has no such column."""
    at = F.array_position(F.transform("header", F.trim), F.lit(name)).cast("int")
    return F.try_element_at(F.col("cells"), F.nullif(at, F.lit(0)))


def list_items(pages: DataFrame, keys: Sequence[str] = ("page_id",), html: str = "html") -> DataFrame:
    """Items of all lists of a page, in page order."""
    items = _all(F.col(html), r"(?is)<li\b[^>]*>(.*?)</li\s*>")
    return pages.select(*keys, F.posexplode(items).alias("pos", "_item")).select(
        *keys, "pos", inner_text(F.col("_item")).alias("item")
    )
