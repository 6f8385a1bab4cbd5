"""Daily case series and their forecast."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.dates import day_of, parse_date
from ..operators import arima
from ..operators.aggregates import group_reports
from ..operators.shape import map_column, with_active
from ..operators.sinks import upsert
from ..operators.windows import with_daily_change
from ..sources.reports import normalise_header, read_drifting_reports, select_measures

CASE_MEASURES = ["Confirmed", "Deaths", "Recovered"]


def case_series(reports: DataFrame, countries: list[str], measures: list[str] = CASE_MEASURES) -> DataFrame:
    """Sum by country and day for the named countries, a zero row for a country
    that is missing in the report of a day.

    One scan and no join: rows of other countries are kept under a null name
    until they have shown that their day exists. The second step holds one row
    per named country and day.
    """
    grouped = group_reports(
        reports.withColumn("Country_Region", F.when(F.col("Country_Region").isin(countries), F.col("Country_Region"))),
        ("Country_Region", "date"), measures,
    )
    entry = F.when(F.col("Country_Region").isNotNull(), F.struct("Country_Region", F.struct(*measures).alias("v")))
    days = grouped.groupBy("date").agg(F.map_from_entries(F.collect_list(entry)).alias("_m"))
    rows = days.select("date", "_m", F.explode(F.array(*[F.lit(c) for c in countries])).alias("Country_Region"))
    found = F.try_element_at("_m", F.col("Country_Region"))
    return rows.select(
        "Country_Region", "date",
        *[F.when(found.isNull(), F.lit(0.0)).otherwise(found[m]).alias(m) for m in measures],
    )


def covid_daily(
    spark: SparkSession, src: str | DataFrame, countries: Mapping[str, int] = C.COUNTRY_IDS, history: DataFrame | None = None
) -> DataFrame:
    """Daily reports to the series with change and active cases.

    ``src`` is a folder of ``extract_date=`` folders, whose files may differ in
    their headers, or the reports read from it. ``history`` is an earlier series (Country_Region, date, measures); a
    day that comes again replaces the old one.
    """
    reports = read_drifting_reports(spark, src) if isinstance(src, str) else src
    reports = normalise_header(reports)
    if "date" not in reports.columns:
        reports = reports.withColumn("date", F.lit(None).cast("string"))
    day = parse_date("date")
    if "extract_date" in reports.columns:
        day = F.coalesce(day, day_of(F.col("extract_date").cast("string")))
    rows = select_measures(reports.withColumn("date", day))
    series = case_series(rows.filter(F.col("date").isNotNull()), list(countries))
    if history is not None:
        series = upsert(series, history.select(*series.columns), ["Country_Region", "date"])
    out = with_active(with_daily_change(series))
    return out.select(
        "date", "Country_Region", *CASE_MEASURES, "Active", *[f"New_{m}" for m in CASE_MEASURES]
    )


def jhons_gold(series: DataFrame, countries: Mapping[str, int] = C.COUNTRY_IDS) -> DataFrame:
    """Export columns of the case series, country as id."""
    return series.select(
        map_column("Country_Region", countries, "int").alias("country"), "date", *CASE_MEASURES, "Active",
        *[f"New_{m}" for m in CASE_MEASURES],
    )


def covid_forecast(
    series: DataFrame, models: DataFrame, h: int = 7, origin=None, history: int | None = 150, old: DataFrame | None = None,
    key: str = "Country_Region", value: str = "New_Confirmed",
) -> DataFrame:
    """Forecast of every series with its stored parameters, merged into earlier
    forecasts; a forecast made again for the same days replaces the old one."""
    new = arima.forecast(series, models, h, origin, history, key, "date", value)
    if old is None:
        return new
    return upsert(new, old.select(*new.columns), [key, "forecast_date", "forecasted_date"])


def forecast_gold(fcst: DataFrame, countries: Mapping[str, int] = C.COUNTRY_IDS, key: str = "Country_Region") -> DataFrame:
    return fcst.select(map_column(key, countries, "int").alias("country"), "forecast_date", "forecasted_date", "forecast")
