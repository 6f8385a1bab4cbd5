"""Scraped country table to its fact rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import clean_number
from ..operators.shape import map_values, only_in, with_mortality
from ..sources.html import extract_html_table

# Columns of the scraped table that are not kept.
DROPPED = ["#", "Continent", "1 Caseevery X ppl", "1 Deathevery X ppl", "1 Testevery X ppl"]
# Names of the kept columns, in the order of the page.
PAGE_ORDER = [
    "Country", "TotalCases", "NewCases", "TotalDeaths", "NewDeaths", "TotalRecovered", "NewRecovered", "ActiveCases",
    "Serious,Critical", "Tot Cases/1M pop", "Deaths/1M pop", "TotalTests", "Tests/1M pop", "Population",
]
# Rows cut at the head and the foot of the table, columns cut at its right.
HEAD, FOOT, RIGHT = 8, 6, 3


def snapshot_rows(
    pages: DataFrame, date_col: str = "date", keys: Sequence[str] = ("page_id",),
    head: int = HEAD, tail: int = FOOT, right: int = RIGHT,
) -> DataFrame:
    """Rows of the country table of each page, with its collection date, numbers
    read from text. All of it is a projection on the page row and its rows."""
    table = extract_html_table(pages, (*keys, date_col), head=head, tail=tail)
    width = F.greatest(F.size("header") - right, F.lit(0))
    pairs = F.slice(F.arrays_zip("header", "cells"), F.lit(1), width)
    kept = F.filter(pairs, lambda p: ~F.trim(p["header"]).isin(DROPPED))
    table = table.select(*keys, date_col, "row_pos", F.transform(kept, lambda p: p["cells"]).alias("_c"))
    cells = {name: F.try_element_at("_c", F.lit(i + 1)) for i, name in enumerate(PAGE_ORDER)}
    return table.select(
        *keys, "row_pos", F.trim(cells["Country"]).alias("Country"), F.col(date_col).alias("Date"),
        *[clean_number(cells[n]).alias(n) for n in C.SNAPSHOT_NUMBERS],
    )


def snapshot_daily(
    pages: DataFrame, countries: Mapping[str, int] = C.COUNTRY_IDS, **cut,
) -> DataFrame:
    """Snapshot pages of any number of days to one table with mortality."""
    return snapshot_gold(snapshot_rows(pages, **cut), countries)


def snapshot_gold(rows: DataFrame, countries: Mapping[str, int] = C.COUNTRY_IDS) -> DataFrame:
    """The wanted countries of snapshot rows, from pages or from stored files
    (numbers may be text), nulls as zero, each row once, with mortality."""
    text = {n for n, kind in rows.dtypes if kind == "string"}
    number = lambda n: clean_number(F.col(f"`{n}`")) if n in text else F.col(f"`{n}`")
    rows = rows.select("Country", "Date", *[number(n).alias(n) for n in C.SNAPSHOT_NUMBERS])
    rows = map_values(only_in(rows, "Country", list(countries)), "Country", countries, "int")
    rows = rows.na.fill(0.0).dropDuplicates()
    return with_mortality(rows)
