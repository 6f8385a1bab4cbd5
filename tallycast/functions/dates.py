"""Date expressions. Bad input gives null, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, pattern: str = "MM-dd-yyyy") -> Column:
    return F.try_to_date(_col(c), pattern)


def reformat_date(c: Column | str, source: str, target: str) -> Column:
    return F.date_format(parse_date(c, source), target)


def day_of(c: Column | str) -> Column:
    """Date of an ISO timestamp kept as text: its first ten characters."""
    return F.try_to_date(F.substring(_col(c), 1, 10), "yyyy-MM-dd")


def target_date(origin: Column | str, horizon: Column | str | int) -> Column:
    h = F.lit(horizon) if isinstance(horizon, int) else _col(horizon).cast("int")
    return F.date_add(_col(origin), h)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def month_end(c: Column | str) -> Column:
    return F.last_day(_col(c))


def day_number(c: Column | str) -> Column:
    """Days since 1970-01-01, so that a range frame can count calendar days."""
    return F.unix_date(_col(c))


def date_spine(spark: SparkSession, start: str, end: str, col: str = "date") -> DataFrame:
    """One row per day, both ends in."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
        ).alias(col)
    )
