"""Filters, column shaping and gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_of
from ..functions.text import blank_to_null_text, clean_number

# ---- filters: all are plain predicates, so they reach the scan -------------


def only(df: DataFrame, value, col: str = "Country_Region") -> DataFrame:
    return df.filter(F.col(col) == value)


def only_in(df: DataFrame, col: str, values) -> DataFrame:
    """Membership in a literal list, or in the first column of a DataFrame."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(col))
        return df.join(keys, col, "left_semi")
    return df.filter(F.col(col).isin(list(values)))


def between_open(df: DataFrame, col: str, low, high) -> DataFrame:
    return df.filter((F.col(col) > F.lit(low)) & (F.col(col) < F.lit(high)))


def between_closed(df: DataFrame, col: str, low, high) -> DataFrame:
    return df.filter(F.col(col).between(F.lit(low), F.lit(high)))


def on_day(df: DataFrame, day: str, col: str = "created_at") -> DataFrame:
    """Rows whose ISO text timestamp falls on ``day``."""
    return df.filter(day_of(col) == F.lit(day).cast("date"))


def before(df: DataFrame, limit, col: str = "created_at") -> DataFrame:
    return df.filter(F.col(col) < F.lit(limit))


def up_to(df: DataFrame, day, col: str = "date") -> DataFrame:
    """Rows up to an origin date, that date included."""
    return df.filter(F.col(col) <= F.lit(day))


def for_date(df: DataFrame, day) -> DataFrame:
    """Rows of one process date: by ``forecast_date`` where the table has it."""
    col = "forecast_date" if "forecast_date" in df.columns else "date"
    return df.filter(F.col(col) == F.lit(day))


# ---- columns ----------------------------------------------------------------


def with_country(df: DataFrame, code, col: str = "country") -> DataFrame:
    return df.withColumn(col, F.lit(code))


def map_column(c: Column | str, mapping: Mapping, to: str | None = None) -> Column:
    """Mapped value of a literal map, the old value where there is none.

    With ``to`` the result has that type, and a value outside the map is cast.
    """
    old = F.col(c) if isinstance(c, str) else c
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    new = F.try_element_at(table, old)
    if to is None:
        return F.coalesce(new, old)
    return F.coalesce(new.cast(to), old.try_cast(to))


def map_values(df: DataFrame, col: str, mapping: Mapping, to: str | None = None) -> DataFrame:
    return df.withColumn(col, map_column(col, mapping, to))


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(cols) if cols else None)


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(0, subset=list(cols) if cols else None)


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    names = list(cols) if cols else [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({n: blank_to_null_text(F.col(f"`{n}`")) for n in names})


def clean_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({n: clean_number(F.col(f"`{n}`")) for n in cols})


def with_active(df: DataFrame, confirmed="Confirmed", deaths="Deaths", recovered="Recovered", out="Active") -> DataFrame:
    zero = F.lit(0.0)
    return df.withColumn(
        out,
        F.coalesce(F.col(confirmed), zero) - F.coalesce(F.col(deaths), zero) - F.coalesce(F.col(recovered), zero),
    )


def with_mortality(df: DataFrame, deaths="TotalDeaths", population="Population", out="Mortality") -> DataFrame:
    """Deaths by population; null, not infinity, where the population is 0."""
    return df.withColumn(out, F.try_divide(F.col(deaths), F.col(population)))


def clamp(df: DataFrame, col: str = "value", low: float = 0.0) -> DataFrame:
    """Values below ``low`` become ``low``; null stays null."""
    return df.withColumn(col, F.when(F.col(col) < low, F.lit(low)).otherwise(F.col(col)))


def sort_rows(df: DataFrame, *cols: str) -> DataFrame:
    """Total order for an export; a range shuffle, so for sinks only."""
    return df.orderBy(*cols)


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Union by column name."""
    for df in rest:
        first = first.unionByName(df)
    return first


# ---- gaps -------------------------------------------------------------------


def fill_missing_days(
    df: DataFrame,
    keys: Sequence[str],
    start: Column | str,
    end: Column | str,
    date: str = "date",
    measures: Sequence[str] = ("Confirmed", "Deaths", "Recovered"),
    key_table: DataFrame | None = None,
) -> DataFrame:
    """A zero row for every (key, day) in the span that has no row at all.

    A row that exists keeps its values, nulls too. The spine is exploded from
    the distinct keys and unioned under the data, so one partially aggregated
    ``groupBy`` replaces the cross join and the outer join. ``start`` and
    ``end`` are dates as text, or columns of ``key_table`` (by default the
    distinct keys of ``df``) for a span per key.
    """
    keys = list(keys)
    if key_table is None:
        key_table = df.select(*keys).distinct()
    low = F.lit(start).cast("date") if isinstance(start, str) else start
    high = F.lit(end).cast("date") if isinstance(end, str) else end
    spine = key_table.select(*keys, F.explode(F.sequence(low, high)).alias(date))
    return fill_rows(df, spine, [*keys, date], measures)


def fill_rows(df: DataFrame, spine: DataFrame, cols: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``df`` and a zero row for every row of ``spine`` it has no row for."""
    seen = df.select(*cols, *measures, F.lit(1).alias("_seen"))
    kinds = dict(df.dtypes)
    empty = spine.select(*cols, *[F.lit(None).cast(kinds[m]).alias(m) for m in measures], F.lit(0).alias("_seen"))
    grouped = seen.unionByName(empty).groupBy(*cols).agg(
        F.max("_seen").alias("_seen"), *[F.sum(m).alias(m) for m in measures]
    )
    return grouped.select(
        *cols, *[F.when(F.col("_seen") == 1, F.col(m)).otherwise(F.lit(0)).cast(kinds[m]).alias(m) for m in measures]
    )
