"""Series preparation and model fitting for all countries in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import arima
from ..operators.aggregates import start_at
from ..operators.shape import between_open, drop_nulls
from ..operators.windows import repair_outliers, repair_zeros

# Code -> (order, rows to train on, outlier limit, repair of zeros).
TRAINING = {
    "AR": ((2, 2, 7), 92, None, False),
    "MX": ((1, 1, 1, 1, 0, 0, 7), 88, None, False),
    "CH": ((1, 1, 3), 93, 35000.0, True),
    "EC": ((1, 1, 1), 88, 10000.0, True),
    "ES": ((2, 1, 2), 103, None, True),
}


def training_table(spark, rows=TRAINING, key: str = "series") -> DataFrame:
    """One row per series: order, train length, outlier limit, zero repair.

    Negative counts are set to zero where zeros are repaired.
    """
    flat = [
        (code, *order, *([0] * (7 - len(order))), n, limit, zeros) for code, (order, n, limit, zeros) in rows.items()
    ]
    fields = ", ".join(f"{c} int" for c in arima.ORDER)
    return spark.createDataFrame(flat, f"`{key}` string, {fields}, train_rows int, outlier double, zeros boolean")


def prepare_series(
    series: DataFrame, table: DataFrame, start="2020-01-01", end="2020-07-31", ge: float | None = 100.0,
    key: str = "series", date: str = "date", value: str = "value",
) -> DataFrame:
    """Cut in time, start at the threshold, repair, keep the train rows.

    Series without a row in ``table`` are left out.
    """
    rows = series.select(key, date, value)
    if start is not None:
        rows = between_open(rows, date, F.lit(start).cast("date"), F.lit(end).cast("date"))
    rows = start_at(drop_nulls(rows), key, ge, date, value)
    rows = rows.join(table.select(key, "train_rows", "outlier", "zeros"), key)
    rows = repair_outliers(rows, F.col("outlier"), key, date, value).drop("repaired")
    positive = F.when(F.col("zeros"), F.greatest(F.col(value), F.lit(0.0))).otherwise(F.col(value))
    rows = rows.withColumn(value, positive)
    fixed = repair_zeros(rows.withColumn("_v", F.when(F.col("zeros"), F.col(value)).otherwise(F.lit(1.0))), key, date, "_v")
    rows = fixed.withColumn(value, F.when(F.col("zeros"), F.col("_v")).otherwise(F.col(value))).drop("_v", "zero_status")
    w = W.partitionBy(key).orderBy(date)
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= F.col("train_rows")).select(key, date, value)


def train_models(
    series: DataFrame, table: DataFrame, start="2020-01-01", end="2020-07-31", ge: float | None = 100.0,
    key: str = "series", date: str = "date", value: str = "value", method: str = "exact",
) -> DataFrame:
    """Parameter table, one row per series, each fitted with its own order."""
    ready = prepare_series(series, table, start, end, ge, key, date, value)
    return arima.fit_arima(ready, table.select(key, *arima.ORDER), key, date, value, method)
