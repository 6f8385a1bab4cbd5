"""One row per series: its days and values as arrays.

A series holds one value per day, so the arrays are bounded by the calendar.
Packing costs the only shuffle; fitting, forecasting and searching then run on
rows that can be joined to parameters and spread over tasks one by one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import task_count

#: Rows that a task holds before it gives them out.
GIVE_OUT = 20_000


def pack(df: DataFrame, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """``key``, ``days`` (days since 1970) and ``values``, in date order, nulls left out. A day that comes twice in a series fails the job."""
    pairs = df.filter(F.col(value).isNotNull() & F.col(date).isNotNull()).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.unix_date(date).alias("d"), F.col(value).cast("double").alias("v")))).alias("_p")
    )
    days = F.col("_p.d")
    twice = F.raise_error(F.concat(F.lit("a day comes twice in series "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("array<int>")
    return pairs.select(key, F.when(F.size(F.array_distinct(days)) < F.size(days), twice).otherwise(days).alias("days"), F.col("_p.v").alias("values"))


def map_rows(df: DataFrame, schema: str, fn: Callable[..., pd.DataFrame | None], *keys: str) -> DataFrame:
    """``fn`` on each packed row, spread evenly over the tasks. Frames are given out as soon as ``GIVE_OUT`` rows are there."""
    def run(batches):
        found, rows = [], 0
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                frame = fn(row)
                if frame is None or not len(frame):
                    continue
                found.append(frame)
                rows += len(frame)
                if rows >= GIVE_OUT:
                    yield pd.concat(found, ignore_index=True)
                    found, rows = [], 0
        if found:
            yield pd.concat(found, ignore_index=True)

    return df.repartition(task_count(df.sparkSession), *keys).mapInPandas(run, schema)


def to_dates(days) -> np.ndarray:
    return np.asarray(days, dtype="datetime64[D]").astype(object)


def key_field(df: DataFrame, key: str) -> str:
    return f"`{key}` {dict(df.dtypes)[key]}"
