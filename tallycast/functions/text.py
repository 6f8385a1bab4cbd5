"""Text expressions; all run inside the JVM on the whole text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: everything but these characters is removed from a lowered text.
KEPT_CHARACTERS = "[^A-Za-z0-9À-ÿ\\- @#]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Lower case, then letters, digits, space, ``@``, ``#`` and ``-`` only."""
    return F.regexp_replace(F.lower(_col(c)), KEPT_CHARACTERS, "")


def remove_stopwords(c: Column | str, words: Sequence[str]) -> Column:
    """Drop the given words, then ``covid`` and ``19`` wherever they stand."""
    tokens = F.split(F.lower(_col(c)), " ", -1)
    kept = F.filter(tokens, lambda t: ~t.isin(list(words))) if words else tokens
    joined = F.array_join(kept, " ")
    return F.replace(F.replace(joined, F.lit("covid"), F.lit("")), F.lit("19"), F.lit(""))


def join_parts(c: Column | str, sep: str = " ") -> Column:
    return F.concat_ws(sep, _col(c))


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def blank_to_null_text(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def clean_number(c: Column | str) -> Column:
    """Number out of scraped text: no ``,``, ``+``, space or ``N/A``; blank is null."""
    stripped = F.replace(F.regexp_replace(_col(c), "[,+ ]", ""), F.lit("N/A"), F.lit(""))
    return stripped.try_cast("double")
