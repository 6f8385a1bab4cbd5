"""Aggregations. All use map-side partial aggregates, so a hot key arrives at
its reducer as one partial row per map task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed value: the floor of the MAPE divisor, the machine epsilon of a double.
EPSILON = 2.220446049250313e-16


def group_reports(
    df: DataFrame, keys: Sequence[str] = ("Country_Region", "date"),
    measures: Sequence[str] = ("Confirmed", "Deaths", "Recovered"),
) -> DataFrame:
    """Sum by day and country; a group with nulls only stays null."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def daily(df: DataFrame, key: str | Column, ts: str | Column, value: Column | None = None) -> DataFrame:
    """Any event table as (series, date, value): row count or sum per day."""
    k = F.col(key) if isinstance(key, str) else key
    t = F.col(ts) if isinstance(ts, str) else ts
    measure = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.groupBy(k.alias("series"), t.cast("date").alias("date")).agg(measure.cast("double").alias("value"))


def monthly_demand(
    df: DataFrame, category: str, areas: Sequence[str] | None = None, start=None, end=None,
    area: str = "Area", date: str = "Date", kind: str = "Category", value: str = "Value",
) -> DataFrame:
    """Demand of one category by area and month; filters stand before the sum."""
    df = df.filter(F.col(kind) == category)
    if areas is not None:
        df = df.filter(F.col(area).isin(list(areas)))
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(date) <= F.lit(end))
    return df.groupBy(area, date).agg(F.sum(value).alias(value))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def row_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def last_dates(df: DataFrame, key: Sequence[str] = ("series",), date: str = "date") -> DataFrame:
    """Last observed day per series: the origin of a forecast."""
    return df.groupBy(*key).agg(F.max(date).alias("origin"))


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, key: Sequence[str], cols: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column, one row per key.

    Quartiles are exact, interpolated. A first pass brackets each with a sketch
    of ``accuracy``; a second counts the values below its bracket and the
    distinct ones inside, about 4 / accuracy of a group, on which the middle
    ranks are found. No state grows with a group. ``df`` is read twice.
    """
    near = 2.0 / accuracy
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"{c}_count"), F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
            F.percentile_approx(
                c, [e for p in QUARTILES.values() for e in (p - near, p + near)], accuracy
            ).alias(f"_{c}_ends"),
        ]
    whole = df.groupBy(*key).agg(*aggs)
    found = whole
    for c in cols:
        found = _same_key(found, _quartiles(df, whole, key, c, accuracy), key)
    out = [f"{c}_{m}" for c in cols for m in ("count", "mean", "std", "min", *QUARTILES, "max")]
    return found.select(*key, *out)


def _same_key(left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys of which nulls are one; the right side's keys go."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in key})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in key], F.lit(True))
    return left.join(right, same, how).drop(*[f"_r_{k}" for k in key])


def _quartiles(df: DataFrame, whole: DataFrame, key: Sequence[str], c: str, accuracy: int) -> DataFrame:
    """Exact quartiles of one column from the brackets in ``whole``; a group of
    at most 4 x ``accuracy`` values is its own bracket, as neighbours of a rank
    may lie outside the sketch's."""
    n = F.col(f"{c}_count")
    few = F.array_repeat(F.array(F.col(f"{c}_min"), F.col(f"{c}_max")), len(QUARTILES))
    ends = F.when(n > 4 * accuracy, F.col(f"_{c}_ends")).otherwise(F.flatten(few))
    ends = whole.select(*key, ends.alias("_ends"), n.alias("_n"))
    rows = _same_key(df.filter(F.col(c).isNotNull()).select(*key, F.col(c).alias("_v")), ends, key, "inner")
    # a value below a bracket only counts: it becomes null, one above is not needed
    at = [
        F.when(F.col("_v") <= F.col("_ends")[2 * i + 1],
               F.struct(F.lit(i).alias("q"), F.when(F.col("_v") >= F.col("_ends")[2 * i], F.col("_v")).alias("v")))
        for i in range(len(QUARTILES))
    ]
    rows = rows.select(*key, "_n", F.inline(F.filter(F.array(*at), lambda s: s.isNotNull())))
    rows = rows.groupBy(*key, "_n", "q", "v").agg(F.count(F.lit(1)).alias("_many"))
    upto = W.partitionBy(*key, "q").orderBy(F.col("v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.sum("_many").over(upto))
    share = F.element_at(F.array(*[F.lit(p) for p in QUARTILES.values()]), F.col("q") + 1)
    place = (F.col("_n") - 1) * share

    def value(rank):
        return F.min(F.when(F.col("_upto") > rank, F.col("v").cast("double")))

    part = rows.groupBy(*key, "q").agg(
        value(F.floor(place)).alias("_a"), value(F.ceil(place)).alias("_b"), F.max(place - F.floor(place)).alias("_f")
    )
    exact = F.when(F.col("_f") == 0, F.col("_a")).otherwise((1 - F.col("_f")) * F.col("_a") + F.col("_f") * F.col("_b"))
    return part.groupBy(*key).agg(
        *[F.max(F.when(F.col("q") == i, exact)).alias(f"{c}_{name}") for i, name in enumerate(QUARTILES)]
    )


def skew(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*key).agg(F.skewness(value).alias("skewness"))


def kurt(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Excess kurtosis, population form."""
    return df.groupBy(*key).agg(F.kurtosis(value).alias("kurtosis"))


def moments(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Skewness and excess kurtosis in one pass."""
    return df.groupBy(*key).agg(F.skewness(value).alias("skewness"), F.kurtosis(value).alias("kurtosis"))


def score(df: DataFrame, by: Sequence[str], observed: str = "observed", forecast: str = "forecast") -> DataFrame:
    """n, r2, rmse, mae, mape and correl in one pass.

    MAPE divides by ``max(|y|, EPSILON)``, so one zero observation makes it
    huge. r2 of a constant observation is 1 for a perfect forecast, else 0; its
    correlation is null.
    """
    y, f = F.col(observed), F.col(forecast)
    e = y - f
    sums = df.filter(y.isNotNull() & f.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPSILON))).alias("mape"),
        F.try_divide(F.covar_pop(y, f), F.stddev_pop(y) * F.stddev_pop(f)).alias("correl"),
    )
    r2 = F.when(F.col("_sst") != 0, 1 - F.try_divide(F.col("_sse"), F.col("_sst"))).otherwise(
        F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    return sums.select(*by, "n", r2.alias("r2"), F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"), "mae", "mape", "correl")


def train_error(df: DataFrame, by: Sequence[str], observed: str = "observed", forecast: str = "forecast") -> DataFrame:
    return score(df, by, observed, forecast).select(*by, "mae", "r2")


def with_total(
    fcst: DataFrame, key: Sequence[str] = ("series",), origin: str = "origin", forecast: str = "forecast"
) -> DataFrame:
    """Sum and mean over the horizons of each origin."""
    return fcst.groupBy(*key, origin).agg(
        F.sum(forecast).alias("total"), F.avg(forecast).alias("mean"), F.count(F.lit(1)).alias("horizons")
    )


def forecast_wide(
    fcst: DataFrame, horizon: int = 7, key: Sequence[str] = ("series",), origin: str = "origin",
    h: str = "h", forecast: str = "forecast",
) -> DataFrame:
    """One row per origin: d1 .. dN and their total. The horizons are known, so
    this is one aggregation without a pass to find the pivot values."""
    days = [F.sum(F.when(F.col(h) == i, F.col(forecast))).alias(f"d{i}") for i in range(1, horizon + 1)]
    wide = fcst.filter(F.col(h).between(1, horizon)).groupBy(*key, origin).agg(*days)
    total = reduce(lambda a, b: a + b, [F.col(f"d{i}") for i in range(1, horizon + 1)])
    return wide.withColumn("total", total)


def minmax(df: DataFrame, key: str = "series", value: str = "value", train: Column | None = None) -> DataFrame:
    """Scale to [0, 1] with bounds of the train rows only (all rows by default).

    Adds ``lo``, ``hi`` and ``scaled``; a constant train part scales to 0, as
    its range is taken as 1.
    """
    source = F.col(value) if train is None else F.when(train, F.col(value))
    w = W.partitionBy(key)
    df = df.withColumns({"lo": F.min(source).over(w), "hi": F.max(source).over(w)})
    span = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))
    return df.withColumn("scaled", (F.col(value) - F.col("lo")) / span)


def minmax_inverse(df: DataFrame, scaled: str = "scaled", out: str = "value") -> DataFrame:
    span = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))
    return df.withColumn(out, F.col(scaled) * span + F.col("lo"))


def start_at(
    df: DataFrame, key: str = "series", ge: float | None = 100.0, date: str = "date", value: str = "value"
) -> DataFrame:
    """Each series from its first day with value >= ``ge``; ``ge=None`` means
    the first day that is not zero. A series with no such day is kept whole."""
    hit = F.col(value) != 0 if ge is None else F.col(value) >= F.lit(ge)
    first = F.min(F.when(hit, F.col(date))).over(W.partitionBy(key))
    return df.withColumn("_first", first).filter(
        F.col("_first").isNull() | (F.col(date) >= F.col("_first"))
    ).drop("_first")


def best(df: DataFrame, key: Sequence[str], metric: str, tie: str = "grid_id") -> DataFrame:
    """Row with the smallest metric per key; the first in grid order on a tie.
    Null and NaN metrics lose to any number."""
    rest = [c for c in df.columns if c not in key]
    bad = F.col(metric).isNull() | F.isnan(metric)
    order = F.struct(bad.alias("bad"), F.col(metric).alias("metric"), F.col(tie).alias("tie"))
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_b")).select(*key, "_b.*")
