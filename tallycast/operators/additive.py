"""Trend + season + event model of each series, its cross-validation and tuning.

A straight trend that may change at evenly spaced days, Fourier seasons and
event regressors, with normal priors as ridge weights. A fit needs only the
sums of products of these columns: Spark adds them up over the days, so a
series is never held as a whole, and a small system per series is solved. For
cross-validation the sums of the days between two cut-offs are added up from
the first on, so a cut-off is a row and no day is read twice. Intervals come
from the residual spread and, beyond the data, from the variance of future
trend changes.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import task_count
from .aggregates import best, score
from .stats import acf_array

# Defaults of the published model.
DEFAULTS = {"changepoint_prior_scale": 0.05, "seasonality_prior_scale": 10.0, "holidays_prior_scale": 10.0}
CHANGEPOINTS, CHANGEPOINT_SHARE = 25, 0.8
WEEKLY_ORDER, YEARLY_ORDER, YEAR = 3, 10, 365.25
Z80 = 1.2815515655446004

#: Where the trend may change, as shares of a series.
KNOTS = [CHANGEPOINT_SHARE * (j + 1) / CHANGEPOINTS for j in range(CHANGEPOINTS)]
#: Days that a series must span for a weekly and a yearly season.
WEEKLY_FROM, YEARLY_FROM = 14, 730
#: Variance of level and slope, as multiples of the largest value.
BASE_VARIANCE = 25.0
#: Event names that a model may have.
MOST_EVENTS = 200


# ---- the columns of the model ----------------------------------------------------


def _waves(day: Column, period: float, order: int) -> list[Column]:
    """Sines, then cosines, of the first harmonics."""
    angles = [2 * math.pi * k * day / period for k in range(1, order + 1)]
    return [F.sin(a) for a in angles] + [F.cos(a) for a in angles]


def _basis(yearly: bool, names: Sequence[str]) -> list[Column]:
    """Columns of a row with ``_day``, ``_start``, ``_span`` and ``_flags``, in the order of the coefficients."""
    day, span = F.col("_day"), F.col("_span")
    t = (day - F.col("_start")) / span
    on = lambda c, days: F.when(span >= days, c).otherwise(0.0)
    weekly = [on(c, WEEKLY_FROM) for c in _waves(day, 7.0, WEEKLY_ORDER)]
    yearly_waves = [on(c, YEARLY_FROM) for c in _waves(day, YEAR, YEARLY_ORDER)] if yearly else []
    flags = [F.when(F.array_contains("_flags", n), 1.0).otherwise(0.0) for n in names]
    return [F.lit(1.0), t, *[F.greatest(t - c, F.lit(0.0)) for c in KNOTS], *weekly, *yearly_waves, *flags]


def _variances(combos: Sequence[Mapping[str, float]], yearly: bool, n_events: int) -> np.ndarray:
    """Prior variance of each coefficient, one row per combination of scales."""
    waves = 2 * (WEEKLY_ORDER + YEARLY_ORDER * yearly)
    return np.array([
        [BASE_VARIANCE] * 2 + [c["changepoint_prior_scale"] ** 2] * CHANGEPOINTS + [c["seasonality_prior_scale"] ** 2] * waves
        + [c["holidays_prior_scale"] ** 2] * n_events
        for c in combos
    ])


def _combos(params: Mapping[str, Sequence] | None) -> list[dict[str, float]]:
    lists = {**{k: [v] for k, v in DEFAULTS.items()}, **(params or {})}
    return [dict(zip(lists, map(float, c))) for c in product(*lists.values())]


def event_names(events: DataFrame | None) -> list[str]:
    """Names of the regressors; more than ``MOST_EVENTS`` are refused."""
    if events is None:
        return []
    found = [r[0] for r in events.select("event").filter("event is not null").distinct().limit(MOST_EVENTS + 1).collect()]
    if len(found) > MOST_EVENTS:
        raise ValueError(f"more than {MOST_EVENTS} event names")
    return sorted(found)


def _days(df: DataFrame, events: DataFrame | None, key: str, date: str, *more: Column) -> DataFrame:
    """``key``, ``_day``, the names of the events of that day as ``_flags``, and ``more``."""
    rows = df.filter(F.col(date).isNotNull()).select(key, F.unix_date(F.col(date).cast("date")).alias("_day"), *more)
    if events is None:
        return rows.withColumn("_flags", F.array().cast("array<string>"))
    side = events.groupBy(key, F.unix_date("date").alias("_day")).agg(F.collect_set("event").alias("_flags"))
    return rows.join(side, [key, "_day"], "left").withColumn("_flags", F.coalesce("_flags", F.array().cast("array<string>")))


def _observed(series: DataFrame, events: DataFrame | None, key: str, date: str, value: str) -> DataFrame:
    """Days with a value, beside the first day and the length of their series."""
    rows = _days(series.filter(F.col(value).isNotNull()), events, key, date, F.col(value).cast("double").alias("_y"))
    ends = rows.groupBy(key).agg(F.min("_day").alias("_start"), F.max("_day").alias("_end"))
    return rows.join(ends, key).withColumn("_span", F.greatest(F.col("_end") - F.col("_start"), F.lit(1)).cast("double"))


# ---- sums of products and their solution -------------------------------------------


def _products(rows: DataFrame, by: Sequence[str], x: Sequence[Column]) -> DataFrame:
    """Rows i = 0 .. len(x) of the products of the columns and the value: ``_i``, ``_r`` (sums over j), ``_top`` (largest value).

    Summed on the map side, so a group reaches its reducer as one row for each column and map task.
    """
    wide = rows.select(*by, F.array(*x, F.col("_y")).alias("_x"))
    long = wide.select(*by, "_x", F.posexplode("_x").alias("_i", "_v"))
    sums = [F.sum(F.col("_v") * F.col("_x")[j]).alias(f"_s{j}") for j in range(len(x) + 1)]
    return long.groupBy(*by, "_i").agg(*sums, F.max(F.abs(F.col("_x")[len(x)])).alias("_top"))


def _solver(variances: np.ndarray):
    """Coefficients and residual spread of each combination, from a matrix of products, the largest value and the
    share of the series that was seen; changes of the trend after the first 0.8 of that share are left out."""
    knots = np.array(KNOTS)

    @F.pandas_udf("array<array<double>>")
    def solve(products: pd.Series, unit: pd.Series, seen: pd.Series) -> pd.Series:
        found = []
        for rows, top, share in zip(products, unit, seen):
            full = np.stack([np.asarray(r, dtype=float) for r in rows])
            p = len(full) - 1
            on = np.ones(p)
            on[2:2 + len(knots)] = knots <= CHANGEPOINT_SHARE * share + 1e-9
            gram, target, squares, n = full[:p, :p] * np.outer(on, on), full[:p, p] * on, full[p, p], full[0, 0]
            noise = max((squares / n - (target[0] / n) ** 2) / (top or 1.0) ** 2, 1e-10)
            system = gram + np.eye(p) * (noise / variances)[:, None, :]
            beta = np.linalg.solve(system, np.broadcast_to(target[:, None], (len(variances), p, 1)))[..., 0]
            left = squares - 2 * beta @ target + np.einsum("ci,ij,cj->c", beta, gram, beta)
            found.append(np.column_stack([beta, np.sqrt(np.maximum(left / n, 0))]).tolist())
        return pd.Series(found)

    return solve


def _models(sums: DataFrame, by: Sequence[str], seen: Column, combos: Sequence[Mapping[str, float]], yearly: bool, names: Sequence[str]) -> DataFrame:
    """One row per group and combination: scales, coefficients by part, spread. Groups of fewer than two days have none."""
    p = 2 + CHANGEPOINTS + 2 * (WEEKLY_ORDER + YEARLY_ORDER * yearly) + len(names)
    row = F.struct("_i", F.array(*[f"_s{j}" for j in range(p + 1)]).alias("r"))
    whole = sums.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("_m"), F.max("_top").alias("_top"))
    whole = whole.filter(F.col("_m")[0]["r"][0] >= 2).select(*by, F.transform("_m", lambda r: r["r"]).alias("_m"), "_top", seen.alias("_seen"))
    solve = _solver(_variances(combos, yearly, len(names)))
    whole = whole.repartition(task_count(sums.sparkSession), *by).withColumn("_b", solve("_m", "_top", "_seen"))
    scales = F.array(*[F.struct(*[F.lit(c[k]).alias(k) for k in DEFAULTS]) for c in combos])
    each = whole.select(*by, "_seen", F.posexplode("_b").alias("grid_id", "_c"))
    edge, parts = 1, []
    for name, size in (("trend", 2 + CHANGEPOINTS), ("weekly", 2 * WEEKLY_ORDER), ("yearly", 2 * YEARLY_ORDER * yearly), ("events", len(names))):
        parts.append(F.slice("_c", edge, size).alias(f"b_{name}"))
        edge += size
    return each.select(
        *by, "grid_id", *[scales[F.col("grid_id")][k].alias(k) for k in DEFAULTS], F.col("_seen").alias("seen"), *parts,
        F.array(*[F.lit(n) for n in names]).cast("array<string>").alias("names"), F.element_at("_c", -1).alias("sigma"),
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _forecasts(rows: DataFrame) -> DataFrame:
    """Mean, interval and components of rows with a day and a model."""
    day = F.col("_day")
    t = (day - F.col("start")) / F.col("span")
    changes = F.slice("b_trend", 3, CHANGEPOINTS)
    knots = F.array(*[F.lit(c) for c in KNOTS])
    trend = F.col("b_trend")[0] + F.col("b_trend")[1] * t + _dot(changes, F.transform(knots, lambda c: F.greatest(t - c, F.lit(0.0))))
    wave = lambda b, period, order: F.when(F.size(b) > 0, _dot(F.col(b), F.array(*_waves(day, period, order)))).otherwise(0.0)
    weekly, yearly = wave("b_weekly", 7.0, WEEKLY_ORDER), wave("b_yearly", YEAR, YEARLY_ORDER)
    events = _dot(F.col("b_events"), F.transform("names", lambda n: F.when(F.array_contains("_flags", n), 1.0).otherwise(0.0)))
    used = F.size(F.filter(knots, lambda c: c <= CHANGEPOINT_SHARE * F.col("seen") + 1e-9))
    size = F.coalesce(F.try_divide(F.aggregate(changes, F.lit(0.0), lambda s, x: s + F.abs(x)), used), F.lit(0.0))
    beyond = F.greatest(t - F.col("seen"), F.lit(0.0))
    half = Z80 * F.sqrt(F.col("sigma") * F.col("sigma") + used * 2 * size * size * F.pow(beyond, F.lit(3)) / (3 * F.col("seen")))
    parts = rows.select("*", trend.alias("trend"), weekly.alias("weekly"), yearly.alias("yearly"), events.alias("events"), half.alias("_half"))
    return parts.withColumn("yhat", F.col("trend") + F.col("weekly") + F.col("yearly") + F.col("events"))


# ---- DataFrame operators --------------------------------------------------------


def event_days(
    intervals: DataFrame, key: str = "series", start: str = "start", end: str = "end", name: str = "event"
) -> DataFrame:
    """Event windows as regressors: one per day of the window, named by the
    event and the offset, so that windows of the same event share them."""
    return intervals.select(
        key, F.col(name).alias("_n"), F.posexplode(F.sequence(F.col(start), F.col(end))).alias("_i", "date")
    ).select(key, "date", F.concat("_n", F.lit("_+"), F.col("_i").cast("string")).alias("event"))


def fit_additive(
    series: DataFrame, params: Mapping[str, Sequence] | None = None, events: DataFrame | None = None,
    key: str = "series", date: str = "date", value: str = "value", yearly: bool = True,
) -> DataFrame:
    """One parameter row per series and combination of prior scales.

    Null days and values are left out, a day that comes twice counts twice, a
    series of fewer than two days has no row. Seasons need 14 and 730 days;
    ``yearly=False`` leaves the yearly one out everywhere.
    """
    names = event_names(events)
    rows = _observed(series, events, key, date, value)
    ends = rows.groupBy(key).agg(F.max("_start").cast("double").alias("start"), F.max("_span").alias("span"))
    sums = _products(rows, [key], _basis(yearly, names))
    return ends.join(_models(sums, [key], F.lit(1.0), _combos(params), yearly, names), key)


def future_frame(
    series: DataFrame, n: int, with_history: bool = False, key: str = "series", date: str = "date"
) -> DataFrame:
    """The n days after the last day of each series, after its own days if asked."""
    future = series.groupBy(key).agg(F.max(date).alias("_m")).select(
        key, F.explode(F.sequence(F.date_add("_m", 1), F.date_add("_m", n))).alias(date)
    )
    return series.select(key, date).unionByName(future) if with_history else future


def predict_additive(
    models: DataFrame, frame: DataFrame, events: DataFrame | None = None, key: str = "series", date: str = "date"
) -> DataFrame:
    """Mean, interval and components for the days in ``frame``, each once."""
    days = _days(frame.select(key, date).distinct(), events, key, date)
    rows = _forecasts(days.join(models, key))
    return rows.select(
        key, "grid_id", F.date_from_unix_date("_day").alias("date"), "yhat", (F.col("yhat") - F.col("_half")).alias("yhat_lower"),
        (F.col("yhat") + F.col("_half")).alias("yhat_upper"), "trend", "weekly", "yearly", "events",
    )


def cutoffs(
    series: DataFrame, horizon: int, period: int | None = None, initial: int | None = None,
    key: str = "series", date: str = "date",
) -> DataFrame:
    """Cut-off days per series, counted back from ``horizon`` days before its
    last day in steps of half a horizon; the train part before the first
    cut-off has at least three horizons."""
    step, first = _steps(horizon, period, initial)
    ends = series.groupBy(key).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    last = F.date_sub("_hi", horizon)
    low = F.date_add("_lo", first)
    spine = F.filter(F.sequence(last, F.least(low, last), F.expr(f"interval -{step} day")), lambda c: c >= low)
    return ends.select(key, F.explode(spine).alias("cutoff"))


def _steps(horizon: int, period: int | None, initial: int | None) -> tuple[int, int]:
    return (period or max(horizon // 2, 1)), (initial if initial is not None else 3 * horizon)


def cross_validate(
    series: DataFrame, params: Mapping[str, Sequence] | None = None, horizon: int = 30, period: int | None = None,
    initial: int | None = None, events: DataFrame | None = None,
    key: str = "series", date: str = "date", value: str = "value", yearly: bool = True,
) -> DataFrame:
    """Forecasts of the ``horizon`` days after each cut-off from a fit on the
    days up to it, for every series and combination of prior scales.

    Columns are those of the whole series; a fit uses the changes of the trend
    in the first 0.8 of its own days. Days fall into steps between cut-offs,
    counted back from the last one, and a running sum over the steps gives the
    products of every cut-off.
    """
    step, first = _steps(horizon, period, initial)
    names = event_names(events)
    rows = _observed(series, events, key, date, value)
    back = F.floor((F.col("_end") - horizon - F.col("_day")) / step).cast("int")
    most = F.floor((F.col("_end") - horizon - first - F.col("_start")) / step).cast("int")
    train = rows.withColumn("_k", F.least(back, most)).filter(F.col("_k") >= 0)
    sums = _products(train, [key, "_k"], _basis(yearly, names))
    columns = [c for c in sums.columns if c.startswith("_s")]
    ends = rows.groupBy(key).agg(F.max("_start").alias("_start"), F.max("_end").alias("_end"), F.max("_span").alias("span"))
    cuts = ends.filter(most >= 0).select(key, "_start", "_end", "span", F.explode(F.sequence(F.lit(0), most)).alias("_k"))
    spine = cuts.select(key, "_k", F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))).alias("_i"))
    upto = W.partitionBy(key, "_i").orderBy(F.desc("_k")).rowsBetween(W.unboundedPreceding, 0)
    whole = spine.join(sums, [key, "_k", "_i"], "left").select(
        key, "_k", "_i", *[F.coalesce(F.sum(c).over(upto), F.lit(0.0)).alias(c) for c in columns], F.max("_top").over(upto).alias("_top")
    )
    cuts = cuts.select(key, "_k", F.col("_start").cast("double").alias("start"), "span", (F.col("_end") - horizon - F.col("_k") * step).alias("_cut"))
    seen = F.col("_cut") - F.col("start")
    whole = whole.join(cuts.select(key, "_k", (seen / F.col("span")).alias("_share")), [key, "_k"])
    models = _models(whole, [key, "_k", "_share"], F.col("_share"), _combos(params), yearly, names)
    ahead = models.join(cuts, [key, "_k"]).withColumn("_day", F.explode(F.sequence(F.col("_cut") + 1, F.col("_cut") + horizon)))
    found = _forecasts(ahead.join(rows.select(key, "_day", "_flags", "_y"), [key, "_day"]))
    return found.select(
        key, "grid_id", *DEFAULTS, F.date_from_unix_date("_cut").alias("cutoff"), F.date_from_unix_date("_day").alias("date"),
        (F.col("_day") - F.col("_cut")).alias("h"), F.col("_y").alias("observed"), F.col("yhat").alias("forecast"),
        (F.col("yhat") - F.col("_half")).alias("yhat_lower"), (F.col("yhat") + F.col("_half")).alias("yhat_upper"),
    )


def tune(
    series: DataFrame, params: Mapping[str, Sequence], horizon: int = 30, key: str = "series", date: str = "date",
    value: str = "value", metric: str = "rmse", **kwargs,
) -> DataFrame:
    """Best combination of prior scales per series by cross-validated error."""
    found = cross_validate(series, params, horizon, key=key, date=date, value=value, **kwargs)
    scored = score(found, [key, "grid_id", *DEFAULTS])
    return best(scored, [key], metric)


def metric_table(*scores: tuple[str, DataFrame], key: str = "series") -> DataFrame:
    """Scores of several models under one another, named."""
    out = None
    for name, df in scores:
        rows = df.select(F.lit(name).alias("model"), key, "n", "r2", "rmse", "mae", "mape", "correl")
        out = rows if out is None else out.unionByName(rows)
    return out


def residual_stats(fitted: DataFrame, key: str = "series", lags: int = 10, date: str = "date", residual: str = "residual") -> DataFrame:
    """Residual diagnostics: moments, autocorrelations and the Ljung-Box sum."""
    r = acf_array(fitted, lags, key, date, residual)
    box = F.aggregate(
        F.sequence(F.lit(1), F.lit(lags)), F.lit(0.0),
        lambda s, i: s + F.try_divide(F.element_at("r", i + 1) * F.element_at("r", i + 1), F.col("n") - i),
    )
    moments = fitted.groupBy(key).agg(
        F.avg(residual).alias("mean"), F.stddev_samp(residual).alias("std"),
        F.skewness(residual).alias("skewness"), F.kurtosis(residual).alias("kurtosis"),
    )
    return moments.join(r.select(key, "n", F.slice("r", 2, lags).alias("acf"),
                                 (F.col("n") * (F.col("n") + 2) * box).alias("ljung_box")), key)
