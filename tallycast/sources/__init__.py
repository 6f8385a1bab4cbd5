from .dims import dim_calendar, dim_countries, dim_happiness, dim_lockdowns
from .grids import html_grids
from .html import extract_html_table, list_items
from .pages import PAGE_SCHEMA, incomplete_chains, read_pages, tweets_of, users_of
from .reports import (
    REPORT_SCHEMA, load_csv_fact, normalise_header, read_drifting_reports, read_reports, read_series,
    read_snapshots, select_measures, stamp, with_extract_date,
)

__all__ = [
    "PAGE_SCHEMA",
    "REPORT_SCHEMA",
    "dim_calendar",
    "dim_countries",
    "dim_happiness",
    "dim_lockdowns",
    "extract_html_table",
    "html_grids",
    "incomplete_chains",
    "list_items",
    "load_csv_fact",
    "normalise_header",
    "read_drifting_reports",
    "read_pages",
    "read_reports",
    "read_series",
    "read_snapshots",
    "select_measures",
    "stamp",
    "tweets_of",
    "users_of",
    "with_extract_date",
]
