"""Registry of queries and the frames they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import daily
from ..session import write_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rnd(c: Column | str, places: int = 6) -> Column:
    """Rounded, with no negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    r = F.round(c, places)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: rnd(c, places) for c in cols})


def r(expr: str, places: int = 6) -> str:
    """The same rounding in SQL."""
    return f"CASE WHEN round({expr}, {places}) = 0 THEN 0.0::DOUBLE ELSE round({expr}, {places}) END"


def series_of(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per priority and day: five long daily series."""
    return daily(table(spark, sf, "orders"), "o_orderpriority", "o_orderdate")


def stored_series(spark: SparkSession, sf: str) -> DataFrame:
    """The series written as a table, for queries that use it more than once:
    the raw orders are read a single time."""
    return write_out(series_of(spark, sf), "series")


# The same series in SQL, to stand after WITH.
S = """s AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS value
FROM orders GROUP BY 1, 2)"""
# The series with its row number.
SN = S + """, n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM s)"""


def status_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as report rows: one country per priority, one measure per status.
    A row counts for its own measure and is null in the others."""
    o = table(spark, sf, "orders")
    one = lambda s: F.when(F.col("o_orderstatus") == s, F.lit(1.0))
    return o.select(
        F.col("o_orderpriority").alias("Country_Region"), F.col("o_orderdate").cast("date").alias("date"),
        one("F").alias("Confirmed"), one("O").alias("Deaths"), one("P").alias("Recovered"),
    )


G = """g AS (SELECT o_orderpriority AS Country_Region, CAST(o_orderdate AS DATE) AS date,
sum(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE END) AS Confirmed,
sum(CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE END) AS Deaths,
sum(CASE WHEN o_orderstatus = 'P' THEN 1.0::DOUBLE END) AS Recovered
FROM orders GROUP BY 1, 2)"""
