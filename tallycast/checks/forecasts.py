"""Models of daily series: fits, forecasts, backtests, scores, tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import additive, arima
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators.sinks import load_models, save_models
from ..operators.windows import forward_mean
from ..plans.covid import covid_forecast
from ..plans.training import prepare_series, train_models
from ..session import scratch_path
from .registry import S, SN, query, r, rnd, rounded, series_of, stored_series

# ---- AR(1): all of it has a closed form ------------------------------------------------

_AR1 = """l AS (SELECT series, value AS y, lag(value) OVER (PARTITION BY series ORDER BY date) AS x FROM n),
ar AS (SELECT series, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy,
  CAST(regr_count(y, x) AS DOUBLE) AS k FROM l GROUP BY 1),
m AS (SELECT series, b, a / (1 - b) AS mean, (syy - b * b * sxx) / k AS sigma2, CAST(k AS BIGINT) AS k FROM ar)"""


@query("ar1", f"""
WITH {SN}, {_AR1} SELECT series, {r('b')} AS phi, round(mean, 6) AS mean, round(sigma2, 6) AS sigma2,
  round(-k / 2.0::DOUBLE * (ln(2 * pi() * sigma2) + 1), 4) AS loglik, k + 1 AS n_obs FROM m""")
def ar1(spark, sf):
    m = arima.fit_ar(series_of(spark, sf), 1)
    return m.select("series", rnd(F.col("ar")[0]).alias("phi"), rnd("mean").alias("mean"), rnd("sigma2").alias("sigma2"),
                    rnd("loglik", 4).alias("loglik"), "n_obs")


@query("ar2", f"""
WITH {SN}, l AS (SELECT series, value AS y, lag(value, 1) OVER w AS x1, lag(value, 2) OVER w AS x2 FROM n WINDOW w AS (PARTITION BY series ORDER BY date)),
c AS (SELECT series, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(y) AS yy, var_pop(x1) AS a, var_pop(x2) AS b, covar_pop(x1, x2) AS ab,
  covar_pop(x1, y) AS ay, covar_pop(x2, y) AS bty, count(*) AS n FROM l WHERE x2 IS NOT NULL GROUP BY 1),
k AS (SELECT *, (ay * b - bty * ab) / (a * b - ab * ab) AS p1, (bty * a - ay * ab) / (a * b - ab * ab) AS p2 FROM c)
SELECT series, {r('p1')} AS phi1, {r('p2')} AS phi2, round((my - p1 * m1 - p2 * m2) / (1 - p1 - p2), 6) AS mean,
  round(yy - p1 * ay - p2 * bty, 6) AS sigma2, n + 2 AS n_obs FROM k""")
def ar2(spark, sf):
    m = arima.fit_ar(series_of(spark, sf), 2)
    return m.select("series", rnd(F.col("ar")[0]).alias("phi1"), rnd(F.col("ar")[1]).alias("phi2"), rnd("mean").alias("mean"),
                    rnd("sigma2").alias("sigma2"), "n_obs")


def _det(m: list[list[str]]) -> str:
    """Determinant of three rows as SQL."""
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


# Covariances of three lags with one another and with the value: Cramer's rule.
_COV = [[f"s{min(i, j)}{max(i, j)}" for j in (1, 2, 3)] for i in (1, 2, 3)]
_AR3 = [
    _det([[f"t{i + 1}" if j == k else _COV[i][j] for j in range(3)] for i in range(3)]) + " / " + _det(_COV) for k in range(3)
]


@query("ar3", f"""
WITH {SN}, l AS (SELECT series, value AS y, lag(value, 1) OVER w AS x1, lag(value, 2) OVER w AS x2, lag(value, 3) OVER w AS x3
  FROM n WINDOW w AS (PARTITION BY series ORDER BY date)),
c AS (SELECT series, count(*) AS n, avg(y) AS my, var_pop(y) AS yy, {', '.join(f'avg(x{i}) AS m{i}, covar_pop(x{i}, y) AS t{i}' for i in (1, 2, 3))},
  {', '.join(f'covar_pop(x{i}, x{j}) AS s{i}{j}' for i in (1, 2, 3) for j in range(i, 4))} FROM l WHERE x3 IS NOT NULL GROUP BY 1),
k AS (SELECT *, {', '.join(f'{e} AS p{i + 1}' for i, e in enumerate(_AR3))} FROM c)
SELECT series, {', '.join(f"{r(f'p{i}')} AS phi{i}" for i in (1, 2, 3))}, round((my - p1 * m1 - p2 * m2 - p3 * m3) / (1 - p1 - p2 - p3), 6) AS mean,
  round(yy - p1 * t1 - p2 * t2 - p3 * t3, 6) AS sigma2, n + 3 AS n_obs FROM k""")
def ar3(spark, sf):
    m = arima.fit_ar(series_of(spark, sf), 3)
    return m.select(
        "series", *[rnd(F.col("ar")[i]).alias(f"phi{i + 1}") for i in range(3)], rnd("mean").alias("mean"), rnd("sigma2").alias("sigma2"), "n_obs"
    )


@query("model_table", f"""
WITH {SN}, {_AR1} SELECT series, CAST(1 AS INT) AS p, {r('b')} AS phi, round(sigma2, 6) AS sigma2 FROM m""")
def model_table(spark, sf):
    """Parameters written as a table and read back."""
    path = scratch_path(spark, "models")
    save_models(arima.fit_ar(series_of(spark, sf), 1), path)
    m = load_models(spark, path)
    return m.select("series", "p", rnd(F.col("ar")[0]).alias("phi"), rnd("sigma2").alias("sigma2"))


@query("ar1_forecast", f"""
WITH {SN}, {_AR1}, z AS (SELECT series, arg_max(value, rn) AS y, max(date) AS date FROM n GROUP BY 1),
h AS (SELECT CAST(unnest(range(1, 8)) AS INT) AS h),
f AS (SELECT z.series, z.date AS forecast_date, z.date + h.h AS forecasted_date, h.h, mean + b ^ h.h * (y - mean) AS f,
  1.959963984540054 * sqrt(sigma2 * list_sum([b ^ (2 * j) for j in range(0, h.h)])) AS w FROM z JOIN m ON m.series = z.series CROSS JOIN h)
SELECT series, forecast_date, forecasted_date, h, round(f, 6) AS forecast, round(f - w, 6) AS mean_ci_lower, round(f + w, 6) AS mean_ci_upper FROM f""")
def ar1_forecast(spark, sf):
    s = stored_series(spark, sf)
    return rounded(arima.forecast(s, arima.fit_ar(s, 1)), "forecast", "mean_ci_lower", "mean_ci_upper")


@query("ar1_backtest", f"""
WITH {SN}, {_AR1}, h AS (SELECT CAST(unnest(range(1, 8)) AS INT) AS h)
SELECT n.series, n.date AS origin, h.h, round(mean + b ^ h.h * (value - mean), 6) AS forecast FROM n JOIN m ON m.series = n.series CROSS JOIN h
WHERE rn >= 92""")
def ar1_backtest(spark, sf):
    s = stored_series(spark, sf)
    return rounded(arima.backtest(s, arima.fit_ar(s, 1), 7, 92), "forecast")


@query("fitted", f"""
WITH {SN}, {_AR1}, p AS (SELECT n.series, date, value, lag(value) OVER (PARTITION BY n.series ORDER BY date) AS x, b, mean FROM n JOIN m ON m.series = n.series)
SELECT series, date, value AS observed, round(mean + b * (x - mean), 6) AS forecast, {r('value - mean - b * (x - mean)')} AS residual FROM p WHERE x IS NOT NULL""")
def fitted(spark, sf):
    s = stored_series(spark, sf)
    return rounded(arima.fitted(s, arima.fit_ar(s, 1)), "forecast", "residual")


_RESID = "p AS (SELECT n.series, date, value, value - mean - b * (lag(value) OVER (PARTITION BY n.series ORDER BY date) - mean) AS e FROM n JOIN m ON m.series = n.series)"


@query("train_error", f"""
WITH {SN}, {_AR1}, {_RESID}
SELECT series, round(avg(abs(e)), 6) AS mae, round(1 - sum(e * e) / (var_pop(value) * count(*)), 6) AS r2 FROM p WHERE e IS NOT NULL GROUP BY 1""")
def train_error(spark, sf):
    s = stored_series(spark, sf)
    return rounded(A.train_error(arima.fitted(s, arima.fit_ar(s, 1)), ["series"]), "mae", "r2")


@query("residual_stats", f"""
WITH {SN}, {_AR1}, {_RESID}, q AS (SELECT series, e, e - avg(e) OVER (PARTITION BY series) AS c, row_number() OVER (PARTITION BY series ORDER BY date) AS k FROM p WHERE e IS NOT NULL),
g AS (SELECT a.series, a.k - b.k AS lag, sum(a.c * b.c) AS c FROM q a JOIN q b ON a.series = b.series AND b.k BETWEEN a.k - 10 AND a.k GROUP BY 1, 2),
t AS (SELECT series, count(*) AS n, stddev_samp(e) AS std, avg(c ^ 2) AS m2, avg(c ^ 3) AS m3, avg(c ^ 4) AS m4 FROM q GROUP BY 1),
b AS (SELECT g.series, sum((g.c / z.c) ^ 2 / (t.n - g.lag)) AS box FROM g JOIN g z ON z.series = g.series AND z.lag = 0 JOIN t ON t.series = g.series
  WHERE g.lag > 0 GROUP BY 1)
SELECT t.series, t.n, round(std, 6) AS std, round(m3 / m2 ^ 1.5, 5) AS skewness, round(m4 / m2 ^ 2 - 3, 5) AS kurtosis,
  round(t.n * (t.n + 2) * box, 5) AS ljung_box FROM t JOIN b ON b.series = t.series""")
def residual_stats(spark, sf):
    s = stored_series(spark, sf)
    d = additive.residual_stats(arima.fitted(s, arima.fit_ar(s, 1))).drop("mean", "acf")
    return rounded(rounded(d, "std"), "skewness", "kurtosis", "ljung_box", places=5)


# ---- fixed ARIMA parameters on new data -----------------------------------------------


def _fixed_models(s):
    """One ARIMA(1,1,1) parameter row per series, a rule of its name."""
    k = s.select("series").distinct()
    none = F.array().cast("array<double>")
    i = F.substring("series", 1, 1).cast("double")
    return k.select(
        "series", F.lit(1).alias("p"), F.lit(1).alias("d"), F.lit(1).alias("q"), *[F.lit(0).alias(c) for c in ("sp", "sd", "sq", "m")],
        F.lit(0.0).alias("mean"), F.array(i / 10).alias("ar"), F.array(-i / 7).alias("ma"), none.alias("sar"), none.alias("sma"),
        i.alias("sigma2"),
    )


_FIXED = """w AS MATERIALIZED (SELECT series, date, value, rn, value - lag(value) OVER (PARTITION BY series ORDER BY date) AS x,
  CAST(left(series, 1) AS DOUBLE) / 10 AS phi, -CAST(left(series, 1) AS DOUBLE) / 7 AS theta FROM n),
e AS (SELECT series, rn, date, value, x, phi, theta, 0.0::DOUBLE AS e FROM w WHERE rn = 2
UNION ALL SELECT w.series, w.rn, w.date, w.value, w.x, w.phi, w.theta, w.x - w.phi * e.x - w.theta * e.e FROM e JOIN w ON w.series = e.series AND w.rn = e.rn + 1),
g AS (SELECT series, rn, date, value, phi, theta, x, phi * x + theta * e AS f1 FROM e)"""


@query("arima_apply", f"""
WITH RECURSIVE {SN}, {_FIXED}, h AS (SELECT CAST(unnest(range(1, 8)) AS INT) AS h)
SELECT series, date AS origin, h.h, {r('value + f1 * list_sum([phi ^ j for j in range(0, h.h)])')} AS forecast FROM g CROSS JOIN h WHERE rn >= 100""")
def arima_apply(spark, sf):
    """Seven-day forecasts of ARIMA(1,1,1) with given parameters from every day on."""
    s = stored_series(spark, sf)
    return rounded(arima.backtest(s, _fixed_models(s), 7, 100), "forecast")


@query("covid_forecast", f"""
WITH RECURSIVE s0 AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2),
n AS (SELECT series, date, value, row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM
  (SELECT * FROM s0 QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) <= 150)), {_FIXED},
h AS (SELECT CAST(unnest(range(1, 8)) AS INT) AS h),
f AS (SELECT g.series AS Country_Region, g.date AS forecast_date, g.date + h.h AS forecasted_date, h.h,
  value + f1 * list_sum([phi ^ j for j in range(0, h.h)]) AS f,
  1.959963984540054 * sqrt(phi * 10 * (1 + coalesce(list_sum([(list_sum([phi ^ i for i in range(0, j + 1)]) + theta * list_sum([phi ^ i for i in range(0, j)])) ^ 2 for j in range(1, h.h)]), 0))) AS w
  FROM g JOIN (SELECT series, max(rn) AS top FROM n GROUP BY 1) t ON t.series = g.series AND t.top = g.rn CROSS JOIN h)
SELECT Country_Region, forecast_date, forecasted_date, h, round(f, 6) AS forecast, round(f - w, 6) AS mean_ci_lower, round(f + w, 6) AS mean_ci_upper FROM f""")
def covid_forecast_query(spark, sf):
    """Last 150 days, stored parameters, 7 days ahead with intervals; run twice,
    the second time merged into the first."""
    stored = stored_series(spark, sf)
    s = stored.select(F.col("series").alias("Country_Region"), "date", F.col("value").alias("New_Confirmed"))
    m = _fixed_models(stored).withColumnRenamed("series", "Country_Region")
    first = covid_forecast(s, m)
    return rounded(covid_forecast(s, m, old=first), "forecast", "mean_ci_lower", "mean_ci_upper")


@query("backfill", f"""
WITH RECURSIVE s0 AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM s0),
w AS (SELECT series, rn, date, value, CAST(left(series, 1) AS DOUBLE) / 10 AS phi, -CAST(left(series, 1) AS DOUBLE) / 7 AS theta,
  list(value) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN 149 PRECEDING AND CURRENT ROW) AS y FROM k),
u AS (SELECT *, [y[j] - (1 + phi) * y[j - 1] + phi * y[j - 2] for j in range(3, len(y) + 1)] AS u FROM w WHERE len(y) >= 2),
g AS (SELECT *, phi * (y[-1] - y[-2]) + theta * coalesce(list_sum([u[j] * (-theta) ^ (len(u) - j) for j in range(1, len(u) + 1)]), 0) AS f1 FROM u)
SELECT series, date AS origin, CAST(h AS INT) AS h, {r('value + f1 * list_sum([phi ^ j for j in range(0, h)])', 6)} AS forecast
FROM g CROSS JOIN (SELECT unnest(range(1, 8)) AS h)""")
def backfill(spark, sf):
    """The forecast of every past day, each from its own last 150 rows."""
    s = stored_series(spark, sf)
    return rounded(arima.backfill(s, _fixed_models(s), s.select("date").distinct(), 7, 150), "forecast", places=6)


# ---- naive forecasts and their scores ---------------------------------------------------


def _naive(s, h: int = 7):
    """Every value of a series repeated for the h days after it."""
    return s.select("series", F.col("date").alias("origin"), F.explode(F.sequence(F.lit(1), F.lit(h))).alias("h"), F.col("value").alias("forecast"))


_NAIVE = "h AS (SELECT CAST(unnest(range(1, 8)) AS INT) AS h), f AS (SELECT series, date AS origin, h, value AS forecast FROM s CROSS JOIN h)"
_AL = "a AS (SELECT f.series, f.origin, f.h, f.origin + f.h AS target_date, f.forecast, s.value AS observed FROM f JOIN s ON s.series = f.series AND s.date = f.origin + f.h)"
_SCORE = """count(*) AS n, CASE WHEN var_pop(observed) <> 0 THEN round(1 - sum((observed - forecast) ^ 2) / (var_pop(observed) * count(*)), 6)
  WHEN sum((observed - forecast) ^ 2) = 0 THEN 1.0 ELSE 0.0 END AS r2,
  round(sqrt(avg((observed - forecast) ^ 2)), 6) AS rmse, round(avg(abs(observed - forecast)), 6) AS mae,
  round(avg(abs(observed - forecast) / greatest(abs(observed), 2.220446049250313e-16)), 6) AS mape, CASE WHEN var_pop(observed) * var_pop(forecast) <> 0 THEN round(corr(observed, forecast), 6) END AS correl"""
_METRICS = ("r2", "rmse", "mae", "mape", "correl")


@query("horizons", f"WITH {S}, {_NAIVE}, {_AL} SELECT * FROM a")
def horizons(spark, sf):
    s = stored_series(spark, sf)
    return J.align_horizons(_naive(s), s)


@query("score", f"WITH {S}, {_NAIVE}, {_AL} SELECT series, h, {_SCORE} FROM a GROUP BY 1, 2")
def score(spark, sf):
    s = stored_series(spark, sf)
    return rounded(A.score(J.align_horizons(_naive(s), s), ["series", "h"]), *_METRICS)


@query("score_mean", f"""
WITH {S}, m AS (SELECT series, date, value AS forecast, CASE WHEN count(value) OVER w = 7 THEN avg(value) OVER w END AS observed FROM s
  WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING))
SELECT series, {_SCORE} FROM m WHERE observed IS NOT NULL GROUP BY 1""")
def score_mean(spark, sf):
    """Mean over the horizons of each origin against the mean of the next seven rows."""
    s = stored_series(spark, sf)
    mean = A.with_total(_naive(s)).select("series", F.col("origin").alias("date"), F.col("mean").alias("forecast"))
    seen = forward_mean(s).select("series", "date", F.col("forward_mean").alias("observed"))
    return rounded(A.score(J.align(mean, seen), ["series"]), *_METRICS)


@query("forecast_wide", f"""
WITH {S} SELECT series, date AS origin, {', '.join(f'value + {i} AS d{i}' for i in range(1, 8))}, 7 * value + 28 AS total FROM s""")
def forecast_wide(spark, sf):
    return A.forecast_wide(_naive(series_of(spark, sf)).withColumn("forecast", F.col("forecast") + F.col("h")), 7)


@query("forecast_total", f"WITH {S} SELECT series, date AS origin, 7 * value AS total, value AS mean, CAST(7 AS BIGINT) AS horizons FROM s")
def forecast_total(spark, sf):
    return A.with_total(_naive(series_of(spark, sf)))


@query("metric_table", f"""
WITH {SN}, {_NAIVE}, {_AL}, {_AR1},
b AS (SELECT n.series, n.date + h.h AS target, mean + b ^ h.h * (value - mean) AS forecast FROM n JOIN m ON m.series = n.series CROSS JOIN h),
c AS (SELECT b.series, b.forecast, s.value AS observed FROM b JOIN s ON s.series = b.series AND s.date = b.target)
SELECT 'naive' AS model, series, {_SCORE} FROM a GROUP BY 2 UNION ALL SELECT 'ar1', series, {_SCORE} FROM c GROUP BY 2""")
def metric_table(spark, sf):
    s = stored_series(spark, sf)
    ar = arima.backtest(s, arima.fit_ar(s, 1), 7)
    parts = [(name, A.score(J.align_horizons(f, s), ["series"])) for name, f in (("naive", _naive(s)), ("ar1", ar))]
    return rounded(additive.metric_table(*parts), *_METRICS)


# ---- fits without a closed form --------------------------------------------------------


@query("arima")
def arima_fit(spark, sf):
    return arima.fit_arima(series_of(spark, sf), [(1, 0, 0), (0, 0, 7), (1, 1, 1), (2, 1, 2)])


@query("seasonal_arima")
def seasonal_arima(spark, sf):
    return arima.fit_arima(series_of(spark, sf), [(1, 1, 1, 1, 0, 0, 7), (0, 1, 2, 0, 1, 2, 7)])


@query("forecast")
def forecast(spark, sf):
    s = stored_series(spark, sf)
    return arima.forecast(s, arima.fit_arima(s, [(1, 1, 1)]))


@query("backtest")
def backtest(spark, sf):
    """Rolling origins after a train part, scored by horizon."""
    s = stored_series(spark, sf)
    f = arima.backtest(s, arima.fit_arima(s, [(1, 1, 1)]), 7, 103, False)
    return A.score(J.align_horizons(f, s), ["series", "h"])


@query("order_stepwise")
def order_stepwise(spark, sf):
    """Stepwise search of the same orders on every daily series, by exact likelihood."""
    return arima.search_stepwise(series_of(spark, sf), d=1, sd=1, m=7, limit=7)


def _training(s):
    """Order, train length, outlier limit and zero repair per series."""
    k = s.select("series").distinct()
    i = F.substring("series", 1, 1).cast("int")
    return k.select(
        "series", (F.lit(1) + i % 2).alias("p"), F.lit(1).alias("d"), F.lit(1).alias("q"), *[F.lit(0).alias(c) for c in ("sp", "sd", "sq", "m")],
        F.lit(500).alias("train_rows"), F.when(i <= 2, F.lit(3.0)).alias("outlier"), (i >= 2).alias("zeros"),
    )


@query("prepare_series", f"""
WITH {S}, a AS (SELECT *, min(CASE WHEN value >= 3 THEN date END) OVER (PARTITION BY series) AS first FROM s
  WHERE date > DATE '1995-06-01' AND date < DATE '2001-01-01'),
b AS (SELECT series, date, value, avg(value) OVER (PARTITION BY series ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS m
  FROM a WHERE date >= first OR first IS NULL),
c AS (SELECT series, date, CASE WHEN left(series, 1) <= '2' AND value > 3 AND m IS NOT NULL THEN m ELSE value END AS value,
  row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM b)
SELECT series, date, round(value, 6) AS value FROM c WHERE rn <= 500""")
def prepare(spark, sf):
    s = stored_series(spark, sf)
    return rounded(prepare_series(s, _training(s), "1995-06-01", "2001-01-01", 3.0), "value")


@query("train_models")
def train(spark, sf):
    s = stored_series(spark, sf)
    return train_models(s, _training(s), "1995-06-01", "2001-01-01", 3.0)


# ---- additive model ---------------------------------------------------------------------


@query("future_frame", f"""
WITH {S}, m AS (SELECT series, max(date) AS last FROM s GROUP BY 1)
SELECT series, last + CAST(unnest(range(1, 15)) AS INT) AS date FROM m UNION ALL SELECT series, date FROM s""")
def future_frame(spark, sf):
    return additive.future_frame(stored_series(spark, sf), 14, with_history=True)


@query("cutoffs", f"""
WITH {S}, m AS (SELECT series, min(date) AS lo, max(date) AS hi FROM s GROUP BY 1)
SELECT series, hi - 30 - CAST(15 * unnest(range(0, (date_diff('day', lo, hi) - 120) // 15 + 1)) AS INT) AS cutoff FROM m""")
def cutoffs(spark, sf):
    return additive.cutoffs(series_of(spark, sf), 30)


def _windows(s):
    """Two windows of one event per series and year."""
    y = s.select("series", F.year("date").alias("y")).distinct()
    spans = [F.struct(F.make_date("y", F.lit(m), F.lit(1)).alias("start"), F.make_date("y", F.lit(m), F.lit(10)).alias("end")) for m in (3, 9)]
    return y.select("series", F.inline(F.array(*spans))).withColumn("event", F.lit("lockdown"))


@query("event_days", f"""
WITH {S}, y AS (SELECT DISTINCT series, year(date) AS y FROM s), w AS (SELECT series, make_date(y, m, 1) AS a FROM y CROSS JOIN (SELECT unnest([3, 9]) AS m)),
d AS (SELECT series, a, CAST(unnest(range(0, 10)) AS INT) AS i FROM w)
SELECT series, a + i AS date, 'lockdown_+' || i AS event FROM d""")
def event_days(spark, sf):
    return additive.event_days(_windows(series_of(spark, sf)))


def _columns_sql(yearly: bool, names: int) -> list[str]:
    """The columns of the additive model, from day, lo, span and ei (number of the day's event)."""
    t = "((day - lo) / span)"
    wave = lambda f, k, period: f"{f}(2 * pi() * {k} * day / {period}::DOUBLE)"
    waves = lambda period, order: [wave(f, k, period) for f in ("sin", "cos") for k in range(1, order + 1)]
    on = lambda days, cols: [f"CASE WHEN span >= {days} THEN {c} ELSE 0.0::DOUBLE END" for c in cols]
    return (
        ["1.0::DOUBLE", t] + [f"greatest({t} - 0.8::DOUBLE * {j} / 25, 0)" for j in range(1, 26)] + on(14, waves(7, 3))
        + (on(730, waves(365.25, 10)) if yearly else []) + [f"CASE WHEN ei = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for i in range(names)]
    )


def _solve_sql(by: str, p: int) -> str:
    """``b``: the system ``a`` (rows of p + 1) of table ``m``, solved by eliminating one unknown in each step; after p
    steps each row is left with its value."""
    return f"""b AS (SELECT {by}, 0 AS step, a FROM m UNION ALL SELECT {by}, step + 1,
  list_append([[a[i][j] - a[i][1] * a[1][j] / a[1][1] for j in range(2, len(a[1]) + 1)] for i in range(2, {p} + 1)],
    [a[1][j] / a[1][1] for j in range(2, len(a[1]) + 1)]) FROM b WHERE step < {p}),
beta AS (SELECT {by}, [r[1] for r in a] AS beta FROM b WHERE step = {p})"""


_DAYS = f"""{S}, o AS (SELECT series, date, value, date_diff('day', DATE '1970-01-01', date) AS day FROM s),
e AS (SELECT series, min(day) AS lo, max(day) AS hi, greatest(max(day) - min(day), 1)::DOUBLE AS span FROM o GROUP BY 1)"""

_X = _columns_sql(True, 10)
_P = len(_X)
_ADDITIVE = f"""
WITH RECURSIVE {_DAYS}, y AS (SELECT DISTINCT series, year(date) AS y FROM s),
ev AS (SELECT series, make_date(y, m, 1) + i AS date, i AS ei FROM y CROSS JOIN (SELECT unnest([3, 9]) AS m) CROSS JOIN (SELECT CAST(unnest(range(0, 10)) AS INT) AS i)),
f AS (SELECT * FROM o UNION ALL SELECT series, DATE '1970-01-01' + CAST(hi + k AS INT), NULL, hi + k FROM e CROSS JOIN (SELECT unnest(range(1, 15)) AS k)),
x AS (SELECT f.series, f.date, day, hi, span, value, [{", ".join(_X)}] AS x FROM f JOIN e ON e.series = f.series LEFT JOIN ev ON ev.series = f.series AND ev.date = f.date),
h AS (SELECT series, day, unnest(range(1, {_P + 2})) AS i, unnest(x || [value]) AS v FROM x WHERE value IS NOT NULL),
g AS (SELECT a.series, a.i, b.i AS j, sum(a.v * b.v) AS v FROM h a JOIN h b ON a.series = b.series AND a.day = b.day WHERE a.i <= {_P} GROUP BY ALL),
n AS (SELECT series, greatest(var_pop(value) / max(abs(value)) ^ 2, 1e-10) AS noise FROM s GROUP BY 1),
m AS (SELECT series, list(r ORDER BY i) AS a FROM (SELECT g.series, i, list(v + CASE WHEN i <> j THEN 0 WHEN i <= 2 THEN noise / 25
  WHEN i <= 27 THEN noise / 0.25 ELSE noise / 100 END ORDER BY j) AS r FROM g JOIN n ON n.series = g.series GROUP BY 1, 2) GROUP BY 1),
{_solve_sql("series", _P)},
r AS (SELECT x.*, beta, list_inner_product(x, beta) AS yhat FROM x JOIN beta ON beta.series = x.series),
k AS (SELECT series, avg((value - yhat) ^ 2) AS s2, any_value(list_sum([abs(c) for c in beta[3:27]])) / 25 AS size FROM r WHERE value IS NOT NULL GROUP BY 1),
t AS (SELECT r.*, 1.2815515655446004 * sqrt(s2 + 50 * size ^ 2 * greatest((day - hi) / span, 0) ^ 3 / 3) AS half FROM r JOIN k ON k.series = r.series)
SELECT series, CAST(0 AS INT) AS grid_id, date, {r("yhat", 4)} AS yhat, {r("yhat - half", 4)} AS yhat_lower, {r("yhat + half", 4)} AS yhat_upper,
  {", ".join(f"{r(f'list_inner_product(x[{a}:{b}], beta[{a}:{b}])', 4)} AS {c}" for c, a, b in (("trend", 1, 27), ("weekly", 28, 33), ("yearly", 34, 53), ("events", 54, 63)))} FROM t"""


@query("additive", _ADDITIVE)
def additive_query(spark, sf):
    """Trend, seasons and event windows; history and 14 days ahead."""
    s = stored_series(spark, sf)
    events = additive.event_days(_windows(s))
    models = additive.fit_additive(s, {"changepoint_prior_scale": [0.5]}, events)
    found = additive.predict_additive(models, additive.future_frame(s, 14, True), events)
    return rounded(found, "yhat", "yhat_lower", "yhat_upper", "trend", "weekly", "yearly", "events", places=4)


def _validated_sql(changes: list[float], seasons: list[float]) -> str:
    """CTEs up to ``v``: observed and forecast values 1 to 30 days after each cut-off, for each pair of prior scales."""
    cols = _columns_sql(False, 0)
    p = len(cols)
    pairs = ", ".join(f"({i}, {c}::DOUBLE, {w}::DOUBLE)" for i, (c, w) in enumerate((c, w) for c in changes for w in seasons))
    on = lambda i: f"CASE WHEN {i} BETWEEN 3 AND 27 AND 0.8::DOUBLE * ({i} - 2) / 25 > 0.8 * seen + 1e-9 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END"
    return f"""RECURSIVE {_DAYS}, x AS (SELECT o.*, lo, hi, [{", ".join(cols)}] AS x FROM o JOIN e ON e.series = o.series),
c AS (SELECT series, k, hi - 30 - 15 * k AS cut, (hi - 30 - 15 * k - lo) / span AS seen
  FROM (SELECT *, unnest(range(0, (hi - 30 - 90 - lo) // 15 + 1)) AS k FROM e WHERE hi - 30 - 90 >= lo)),
h AS (SELECT series, day, (hi - 30 - day) // 15 AS k, unnest(range(1, {p + 2})) AS i, unnest(x || [value]) AS v FROM x WHERE day <= hi - 30),
g AS (SELECT a.series, a.k, a.i, b.i AS j, sum(a.v * b.v) AS v FROM h a JOIN h b ON a.series = b.series AND a.day = b.day WHERE a.i <= {p} GROUP BY ALL),
q AS (SELECT c.series, c.k, i, j, sum(v) * {on("i")} * {on("j")} AS v FROM c JOIN g ON g.series = c.series AND g.k >= c.k GROUP BY c.series, c.k, i, j, seen),
n AS (SELECT c.series, c.k, greatest(var_pop(value) / max(abs(value)) ^ 2, 1e-10) AS noise FROM c JOIN o ON o.series = c.series AND day <= cut
  GROUP BY 1, 2 HAVING count(*) >= 2),
w AS (SELECT * FROM (VALUES {pairs}) AS t(grid_id, cp, sp)),
m AS (SELECT series, k, grid_id, list(r ORDER BY i) AS a FROM (SELECT q.series, q.k, grid_id, i, list(v + CASE WHEN i <> j THEN 0
  WHEN i <= 2 THEN noise / 25 WHEN i <= 27 THEN noise / cp ^ 2 ELSE noise / sp ^ 2 END ORDER BY j) AS r
  FROM q JOIN n ON n.series = q.series AND n.k = q.k CROSS JOIN w GROUP BY ALL) GROUP BY ALL),
{_solve_sql("series, k, grid_id", p)},
v AS (SELECT c.series, grid_id, CAST(day - cut AS INT) AS h, value AS observed, list_inner_product(x, beta) AS forecast
  FROM beta JOIN c ON c.series = beta.series AND c.k = beta.k JOIN x ON x.series = c.series AND day BETWEEN cut + 1 AND cut + 30)"""


# Without the yearly season, which keeps the systems that the SQL solves small; ``additive`` has it.
@query("cross_validate", f"WITH {_validated_sql([0.05], [10.0])} SELECT series, h, {_SCORE} FROM v GROUP BY 1, 2")
def cross_validate(spark, sf):
    found = additive.cross_validate(stored_series(spark, sf), horizon=30, yearly=False)
    return rounded(A.score(found, ["series", "h"]), *_METRICS)


_GRID = {"changepoint_prior_scale": [0.001, 0.01, 0.1, 0.5], "seasonality_prior_scale": [0.01, 0.1, 1.0, 10.0]}


@query("tune", f"""
WITH {_validated_sql(*_GRID.values())}, z AS (SELECT series, grid_id, {_SCORE} FROM v GROUP BY 1, 2)
SELECT series, cp AS changepoint_prior_scale, sp AS seasonality_prior_scale, 10.0::DOUBLE AS holidays_prior_scale, n, r2, rmse, mae, mape, correl
FROM z JOIN w ON w.grid_id = z.grid_id QUALIFY row_number() OVER (PARTITION BY series ORDER BY rmse) = 1""")
def tune(spark, sf):
    found = additive.tune(stored_series(spark, sf), _GRID, 30, yearly=False)
    scales = list(additive.DEFAULTS)
    return rounded(found, *_METRICS).select("series", *scales, "n", *_METRICS)
