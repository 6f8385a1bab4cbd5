"""Description and tests of daily series."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import stats as Z
from ..operators.unit_root import adf as adf_test
from ..operators.wavelet import global_spectrum, wavelet_power
from .registry import S, SN, query, r, rnd, rounded, series_of

_DESCRIBE = ", ".join(
    f"count({c}) AS {c}_count, round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std, min({c}) AS {c}_min, "
    f"quantile_cont({c}, 0.25) AS {c}_q25, quantile_cont({c}, 0.5) AS {c}_q50, quantile_cont({c}, 0.75) AS {c}_q75, max({c}) AS {c}_max"
    for c in ("value", "total")
)


@query("describe", f"""
WITH {S}, t AS (SELECT *, sum(value) OVER (PARTITION BY series ORDER BY date) AS total FROM s)
SELECT series, {_DESCRIBE} FROM t GROUP BY 1""")
def describe(spark, sf):
    """Daily counts and their running total, as measures of one series."""
    s = series_of(spark, sf).withColumn("total", F.sum("value").over(W.partitionBy("series").orderBy("date")))
    d = A.describe(s, ["series"], ["value", "total"])
    return rounded(d, "value_mean", "value_std", "total_mean", "total_std")


@query("moments", f"""
WITH {S}, m AS (SELECT series, avg(value) AS m, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT s.series, sum((value - m) ^ 2) / n AS m2, sum((value - m) ^ 3) / n AS m3, sum((value - m) ^ 4) / n AS m4
  FROM s JOIN m ON m.series = s.series GROUP BY s.series, n)
SELECT series, round(m3 / m2 ^ 1.5, 6) AS skewness, round(m4 / m2 ^ 2 - 3, 6) AS kurtosis FROM c""")
def moments(spark, sf):
    return rounded(A.moments(series_of(spark, sf), ["series"], "value"), "skewness", "kurtosis")


@query("skew", f"""
WITH {S}, m AS (SELECT series, value - avg(value) OVER (PARTITION BY series) AS d FROM s)
SELECT series, round(avg(d ^ 3) / avg(d ^ 2) ^ 1.5, 6) AS skewness FROM m GROUP BY 1""")
def skew(spark, sf):
    return rounded(A.skew(series_of(spark, sf), ["series"], "value"), "skewness")


@query("kurt", f"""
WITH {S}, m AS (SELECT series, value - avg(value) OVER (PARTITION BY series) AS d FROM s)
SELECT series, round(avg(d ^ 4) / avg(d ^ 2) ^ 2 - 3, 6) AS kurtosis FROM m GROUP BY 1""")
def kurt(spark, sf):
    return rounded(A.kurt(series_of(spark, sf), ["series"], "value"), "kurtosis")


@query("bartlett", f"""
WITH {SN}, g AS (SELECT series, CASE WHEN rn <= 62 THEN 0 WHEN rn <= 124 THEN 1 ELSE 2 END AS k, count(*) - 1 AS f,
  var_samp(value) AS v FROM n GROUP BY 1, 2),
t AS (SELECT series, sum(f) AS ff, (sum(f) * ln(sum(f * v) / sum(f)) - sum(f * ln(v))) /
  (1 + (sum(1.0::DOUBLE / f) - 1.0::DOUBLE / sum(f)) / 6) AS x FROM g GROUP BY 1)
SELECT series, round(x, 6) AS statistic, round(exp(-x / 2), 6) AS p FROM t""")
def bartlett(spark, sf):
    return rounded(Z.bartlett(series_of(spark, sf)), "statistic", "p")


def _both_tails(z: str) -> str:
    """2 P(Z > z) of the normal distribution, by the series of its odd powers; 1 for z below zero."""
    term = f"exp((2 * k + 1) * ln({z}) - (k + 1) * ln(2) - lgamma(k + 1.5) + 0.5 * ln(pi()))"
    return (
        f"CASE WHEN {z} <= 1e-9 THEN 1.0::DOUBLE WHEN {z} > 8 THEN 0.0::DOUBLE ELSE "
        f"1 - 2 * exp(-{z} * {z} / 2) / sqrt(2 * pi()) * list_sum([{term} for k in range(0, 120)]) END"
    )


@query("mann_whitney", f"""
WITH {SN}, k AS (SELECT series, rn <= 98 AS early, rank() OVER w + (count(*) OVER (PARTITION BY series, value) - 1) / 2.0::DOUBLE AS rk
  FROM n WINDOW w AS (PARTITION BY series ORDER BY value)),
t AS (SELECT series, sum(c * c * c - c) AS ties FROM (SELECT series, value, CAST(count(*) AS DOUBLE) AS c FROM s GROUP BY 1, 2) GROUP BY 1),
u AS (SELECT series, CAST(count(*) FILTER (early) AS DOUBLE) AS a, CAST(count(*) FILTER (NOT early) AS DOUBLE) AS b,
  sum(rk) FILTER (early) AS ra FROM k GROUP BY 1),
v AS (SELECT u.series, a, b, ra - a * (a + 1) / 2 AS x, ties FROM u JOIN t ON t.series = u.series),
z AS (SELECT series, x, (abs(x - a * b / 2) - 0.5) / sqrt(a * b / 12 * (a + b + 1 - ties / ((a + b) * (a + b - 1)))) AS z FROM v)
SELECT series, x AS statistic, round(z, 6) AS z, {r(_both_tails('z'))} AS p FROM z""")
def mann_whitney(spark, sf):
    return rounded(Z.mann_whitney(series_of(spark, sf)), "z", "p")


@query("mann_kendall", f"""
WITH {SN}, p AS (SELECT a.series, sign(b.value - a.value) AS sg, (b.value - a.value) / (b.rn - a.rn) AS sl
  FROM n a JOIN n b ON a.series = b.series AND a.rn < b.rn),
q AS (SELECT series, CAST(sum(sg) AS BIGINT) AS s, median(sl) AS slope FROM p GROUP BY 1),
t AS (SELECT series, sum(c * (c - 1) * (2 * c + 5)) AS ties FROM (SELECT series, value, CAST(count(*) AS DOUBLE) AS c FROM s GROUP BY 1, 2) GROUP BY 1),
m AS (SELECT series, count(*) AS n, median(value) AS med FROM s GROUP BY 1),
v AS (SELECT m.series, m.n, q.s, CAST(q.s AS DOUBLE) / (0.5 * m.n * (m.n - 1)) AS tau,
  (CAST(m.n AS DOUBLE) * (m.n - 1) * (2 * m.n + 5) - ties) / 18 AS var_s, slope, med - (m.n - 1) / 2.0::DOUBLE * slope AS intercept
  FROM m JOIN q ON q.series = m.series JOIN t ON t.series = m.series),
z AS (SELECT *, CASE WHEN s = 0 THEN 0 ELSE (s - sign(s)) / sqrt(var_s) END AS z FROM v)
SELECT series, n, s, round(tau, 6) AS tau, round(var_s, 3) AS var_s, round(z, 6) AS z, {r(_both_tails('abs(z)'))} AS p,
  CASE WHEN {_both_tails('abs(z)')} >= 0.05 THEN 'no trend' WHEN z > 0 THEN 'increasing' ELSE 'decreasing' END AS trend,
  {r('slope')} AS slope, round(intercept, 6) AS intercept FROM z""")
def mann_kendall(spark, sf):
    d = Z.mann_kendall(series_of(spark, sf))
    return rounded(d, "tau", "z", "p", "slope", "intercept").withColumn("var_s", rnd("var_s", 3))


_R = f"""m AS (SELECT series, rn, value - avg(value) OVER (PARTITION BY series) AS d FROM n),
c AS (SELECT a.series, a.rn - b.rn AS lag, sum(a.d * b.d) AS c FROM m a JOIN m b ON a.series = b.series AND b.rn BETWEEN a.rn - 20 AND a.rn GROUP BY 1, 2),
r AS (SELECT x.series, x.lag, x.c / z.c AS r, k.n FROM c x JOIN c z ON z.series = x.series AND z.lag = 0
  JOIN (SELECT series, count(*) AS n FROM s GROUP BY 1) k ON k.series = x.series)"""


@query("acf", f"""
WITH {SN}, {_R}
SELECT series, CAST(lag AS INT) AS lag, {r('r')} AS r, round(CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 * sqrt((1 + 2 *
  (coalesce(sum(r * r) OVER (PARTITION BY series ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) - 1)) / n) END, 6) AS bound FROM r""")
def acf(spark, sf):
    return rounded(Z.acf(series_of(spark, sf), 20), "r", "bound")


@query("pacf", f"""
WITH RECURSIVE {SN}, {_R}, a AS (SELECT series, n, list(r ORDER BY lag) AS r FROM r GROUP BY 1, 2),
d AS (SELECT series, n, r, 1 AS k, [r[2]] AS phi, r[2] AS last FROM a
UNION ALL SELECT series, n, r, k + 1,
  list_append([phi[j] - x * phi[k + 1 - j] for j in range(1, k + 1)], x), x
  FROM (SELECT *, (r[k + 2] - list_sum([phi[j] * r[k + 2 - j] for j in range(1, k + 1)])) /
    (1 - list_sum([phi[j] * r[j + 1] for j in range(1, k + 1)])) AS x FROM d WHERE k < 20))
SELECT series, CAST(k AS INT) AS lag, {r('last')} AS pacf, round(1.959963984540054 / sqrt(n), 6) AS bound FROM d""")
def pacf(spark, sf):
    return rounded(Z.pacf(series_of(spark, sf), 20).filter(F.col("lag") > 0), "pacf", "bound")


# Each series at its orders of differencing 0 to 3, as ``p``.
_DIFFERENCED = f"""{S}, d0 AS (SELECT series, date, 0 AS d, value AS u FROM s),
{", ".join(f"d{i} AS (SELECT series, date, {i} AS d, u - lag(u) OVER (PARTITION BY series ORDER BY date) AS u FROM d{i - 1} QUALIFY lag(date) OVER (PARTITION BY series ORDER BY date) IS NOT NULL)" for i in (1, 2, 3))},
p AS ({" UNION ALL ".join(f"SELECT * FROM d{i}" for i in range(4))})"""


@query("adf_lag0", f"""
WITH {_DIFFERENCED},
l AS (SELECT series, d, lag(u) OVER w AS x, u - lag(u) OVER w AS y FROM p WINDOW w AS (PARTITION BY series, d ORDER BY date)),
f AS (SELECT series, d, regr_slope(y, x) AS b, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_count(y, x) AS n FROM l GROUP BY 1, 2)
SELECT series, CAST(d AS INT) AS d, round(b / sqrt((syy - b * b * sxx) / (n - 2) / sxx), 5) AS statistic, CAST(0 AS BIGINT) AS lags,
  CAST(n AS BIGINT) AS n_used FROM f""")
def adf_lag0(spark, sf):
    """The unit-root regression without lagged changes, which has a closed form."""
    return rounded(adf_test(series_of(spark, sf), max_lag=0), "statistic", places=5).drop("p")


def _regression(chosen: str, at: str) -> str:
    """CTEs that eliminate constant and lagged changes, one by one, from the products of all columns over the days after
    lag ``l`` of table ``chosen``; ``f{at}`` has the rest of the matrix ``a`` after ``step`` columns."""
    return f"""x{at} AS (SELECT e.series, e.d, e.t, unnest(range(0, k.l + 3)) AS i,
  unnest([1.0::DOUBLE] || list_reverse(e.back)[1:k.l] || [e.u, e.y]) AS v FROM e JOIN {chosen} k ON k.series = e.series AND k.d = e.d WHERE e.t > k.l),
g{at} AS (SELECT a.series, a.d, a.i, b.i AS j, sum(a.v * b.v) AS v FROM x{at} a JOIN x{at} b ON a.series = b.series AND a.d = b.d AND a.t = b.t GROUP BY ALL),
m{at} AS (SELECT series, d, list(r ORDER BY i) AS a FROM (SELECT series, d, i, list(v ORDER BY j) AS r FROM g{at} GROUP BY 1, 2, 3) GROUP BY 1, 2),
f{at} AS (SELECT series, d, 0 AS step, a FROM m{at} UNION ALL SELECT series, d, step + 1,
  [[a[i][j] - a[i][1] * a[1][j] / a[1][1] for j in range(2, len(a) + 1)] for i in range(2, len(a) + 1)] FROM f{at} WHERE len(a) > 2)"""


_LEFT = "(a[-1][-1] - a[-2][-1] ^ 2 / a[-2][-2])"
_SURFACE = (
    "CASE WHEN statistic <= -1.61 THEN 2.1659 + 1.4412 * statistic + 0.038269 * statistic ^ 2 "
    "ELSE 1.7339 + 0.93202 * statistic - 0.12745 * statistic ^ 2 - 0.010368 * statistic ^ 3 END"
)


@query("adf", f"""
WITH RECURSIVE {_DIFFERENCED},
c AS (SELECT series, d, row_number() OVER w AS t, u - floor(avg(u) OVER (PARTITION BY series, d)) AS u, lead(u) OVER w - u AS y
  FROM p WINDOW w AS (PARTITION BY series, d ORDER BY date)),
e AS (SELECT *, coalesce(list(y) OVER (PARTITION BY series, d ORDER BY t ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING), []) AS back
  FROM c WHERE y IS NOT NULL),
k AS (SELECT series, d, count(*) AS n, CAST(least(ceil(12 * (count(*) / 100) ^ 0.25), count(*) // 2 - 2) AS BIGINT) AS l FROM p GROUP BY 1, 2),
{_regression("k", "0")},
b AS (SELECT k.series, k.d, k.n, arg_min(f.step - 1, (k.n - 1 - k.l) * ln({_LEFT}) + 2 * f.step) AS l
  FROM f0 f JOIN k ON k.series = f.series AND k.d = f.d WHERE f.step > 0 GROUP BY 1, 2, 3),
{_regression("b", "1")},
z AS (SELECT b.series, b.d, b.l, b.n - 1 - b.l AS used, a[1][2] / sqrt({_LEFT} / (b.n - 2 * b.l - 3) * a[1][1]) AS statistic
  FROM f1 f JOIN b ON b.series = f.series AND b.d = f.d WHERE len(a) = 2),
q AS (SELECT *, {_SURFACE} AS z FROM z)
SELECT series, CAST(d AS INT) AS d, {r("statistic", 4)} AS statistic, {r(f"""CASE WHEN statistic > 2.74 THEN 1.0::DOUBLE WHEN statistic < -18.83 THEN 0.0::DOUBLE
  WHEN z < 0 THEN 0.5 * {_both_tails("abs(z)")} ELSE 1 - 0.5 * {_both_tails("abs(z)")} END""")} AS p,
  CAST(l AS BIGINT) AS lags, CAST(used AS BIGINT) AS n_used FROM q""")
def adf(spark, sf):
    return rounded(adf_test(series_of(spark, sf)), "p").withColumn("statistic", rnd("statistic", 4))


@query("periodogram", f"""
WITH {SN}, t AS (SELECT series, count(*) AS n, sqrt(sum(value * value)) AS l FROM s GROUP BY 1),
k AS (SELECT series, n, l, CAST(unnest(range(1, n // 2 + 1)) AS BIGINT) AS k FROM t)
SELECT k.series, k.k, round(k.n / CAST(k.k AS DOUBLE), 6) AS period,
  {r("sqrt(sum(value / l * cos(2 * pi() * ((k.k * (n.rn - 1)) % k.n) / k.n)) ^ 2 + sum(value / l * sin(2 * pi() * ((k.k * (n.rn - 1)) % k.n) / k.n)) ^ 2)", 4)} AS amplitude
FROM k JOIN n ON n.series = k.series GROUP BY k.series, k.k, k.n""")
def periodogram(spark, sf):
    return rounded(Z.periodogram(series_of(spark, sf)), "period").withColumn("amplitude", rnd("amplitude", 4))


@query("wavelet")
def wavelet(spark, sf):
    return wavelet_power(series_of(spark, sf))


@query("wavelet_global")
def wavelet_global(spark, sf):
    return global_spectrum(series_of(spark, sf))
