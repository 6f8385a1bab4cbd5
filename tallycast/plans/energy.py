"""Electricity demand by country and month."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.aggregates import monthly_demand
from ..operators.shape import map_column


def energy_load(
    df: DataFrame, category: str = "Electricity demand", areas: Mapping[str, int] = C.COUNTRY_IDS,
    start: str | None = "2019-01-01", end: str | None = "2021-12-31", names: Mapping[str, str] = C.LOCAL_NAMES,
) -> DataFrame:
    """Rows of the demand fact, with the shown name beside the id.

    ``df`` has Area, Date (date or ISO text), Category and Value.
    """
    days = df.withColumn("Date", F.to_date("Date") if dict(df.dtypes)["Date"] != "date" else F.col("Date"))
    low = None if start is None else F.lit(start).cast("date")
    high = None if end is None else F.lit(end).cast("date")
    demand = monthly_demand(days, category, _names(areas), low, high)
    return demand.select(
        map_column("Area", areas, "int").alias("country"), map_column("Area", names).alias("name") if names else F.col("Area").alias("name"),
        F.col("Date").alias("date"), F.col("Value").alias("value"),
    )


def _names(areas: Mapping[str, int]) -> Sequence[str]:
    return list(areas)
