"""Dimension rows that the warehouse starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.dates import date_spine


def _values(spark: SparkSession, rows: list[tuple], *columns: Column) -> DataFrame:
    """Literal rows: a local relation, whose size Spark knows to be small."""
    def literal(v) -> str:
        return "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else repr(v)

    lines = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {lines}").select(*columns)


def dim_countries(spark: SparkSession) -> DataFrame:
    return _values(spark, C.COUNTRIES, F.col("col1").alias("ID"), F.col("col2").alias("pais"))


def dim_happiness(spark: SparkSession) -> DataFrame:
    return _values(
        spark, C.HAPPINESS, F.col("col1").alias("PAISES_ID"), F.col("col2").alias("ano"),
        F.col("col3").alias("periodo_referencia"), F.col("col4").cast("double").alias("nota"), F.col("col5").alias("classificacao"),
    )


def dim_lockdowns(spark: SparkSession) -> DataFrame:
    return _values(
        spark, C.LOCKDOWNS, F.col("col1").alias("PAISES_ID"), F.col("col2").cast("date").alias("data_inicio"),
        F.col("col3").cast("date").alias("data_fim"), F.col("col4").alias("total_dias"),
    )


def dim_calendar(
    spark: SparkSession, start: str = C.CALENDAR_START, end: str = C.CALENDAR_END
) -> DataFrame:
    return date_spine(spark, start, end, "data")
