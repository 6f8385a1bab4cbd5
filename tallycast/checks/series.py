"""Windows over daily series."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import windows as X
from ..operators.joins import grid
from ..operators.shape import clamp
from .cases import missing_days
from .registry import S, SN, query, r, rnd, rounded, series_of, stored_series


@query("trailing_mean", f"""
WITH {S} SELECT series, date, value, round(CASE WHEN count(value) OVER w = 7 THEN avg(value) OVER w END, 6) AS trailing_mean
FROM s WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def trailing_mean(spark, sf):
    return rounded(X.trailing_mean(series_of(spark, sf)), "trailing_mean")


@query("forward_mean", f"""
WITH {S} SELECT series, date, value, round(CASE WHEN count(value) OVER w = 7 THEN avg(value) OVER w END, 6) AS forward_mean
FROM s WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING)""")
def forward_mean(spark, sf):
    return rounded(X.forward_mean(series_of(spark, sf)), "forward_mean")


@query("difference", f"""
WITH {S}, a AS (SELECT series, date, value, value - lag(value) OVER (PARTITION BY series ORDER BY date) AS d1 FROM s),
b AS (SELECT *, d1 - lag(d1) OVER (PARTITION BY series ORDER BY date) AS d2 FROM a),
c AS (SELECT *, d2 - lag(d2) OVER (PARTITION BY series ORDER BY date) AS d3 FROM b)
SELECT series, date, value, d3 AS diff FROM c WHERE d3 IS NOT NULL""")
def difference(spark, sf):
    return X.difference(series_of(spark, sf), 3)


@query("last_n", f"""
WITH {S} SELECT series, date, value FROM s QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) <= 150""")
def last_n(spark, sf):
    return X.last_n(series_of(spark, sf), 150)


@query("head_tail", f"""
WITH {SN}, m AS (SELECT *, max(rn) OVER (PARTITION BY series) AS top FROM n)
SELECT series, date, value, 'head' AS part FROM m WHERE rn <= 30
UNION ALL SELECT series, date, value, 'tail' FROM m WHERE rn > top - 30""")
def head_tail(spark, sf):
    s = stored_series(spark, sf)
    return X.head_n(s, 30).withColumn("part", F.lit("head")).unionByName(X.tail_n(s, 30).withColumn("part", F.lit("tail")))


@query("split", f"""
WITH {SN} SELECT series, date, value, CASE WHEN rn <= 92 THEN 'train' ELSE 'test' END AS part,
  CASE WHEN rn <= round_even(0.7 * count(*) OVER (PARTITION BY series), 0) THEN 'train' ELSE 'test' END AS share FROM n""")
def split(spark, sf):
    s = X.split(series_of(spark, sf), 92)
    return X.split(s.withColumnRenamed("part", "first"), share=0.7).withColumnRenamed("part", "share").withColumnRenamed("first", "part")


@query("slices", f"""
WITH {SN} SELECT series, date, value, CASE WHEN rn <= 62 THEN 0 WHEN rn <= 124 THEN 1 ELSE 2 END AS slice FROM n""")
def slices(spark, sf):
    return X.slices(series_of(spark, sf), [62, 124])


@query("lag_matrix", f"""
WITH {SN} SELECT series, date, {', '.join(f'lag(value, {7 - i}) OVER w AS x{i + 1}' for i in range(7))}, value AS y
FROM n WINDOW w AS (PARTITION BY series ORDER BY date) QUALIFY rn > 7""")
def lag_matrix(spark, sf):
    return X.lag_matrix(series_of(spark, sf))


@query("minmax", f"""
WITH {S}, m AS (SELECT *, min(CASE WHEN date < DATE '1999-01-01' THEN value END) OVER (PARTITION BY series) AS lo,
  max(CASE WHEN date < DATE '1999-01-01' THEN value END) OVER (PARTITION BY series) AS hi FROM s)
SELECT series, date, value, lo, hi, round((value - lo) / (hi - lo), 6) AS scaled, value AS restored FROM m""")
def minmax(spark, sf):
    m = A.minmax(series_of(spark, sf), train=F.col("date") < F.lit("1999-01-01").cast("date"))
    return rounded(A.minmax_inverse(m, out="restored"), "scaled", "restored")


@query("start_at", f"""
WITH {S}, f AS (SELECT *, min(CASE WHEN value >= 5 THEN date END) OVER (PARTITION BY series) AS first FROM s)
SELECT series, date, value FROM f WHERE first IS NULL OR date >= first""")
def start_at(spark, sf):
    return A.start_at(series_of(spark, sf), ge=5.0)


@query("repair_outliers", f"""
WITH {S}, m AS (SELECT *, avg(value) OVER (PARTITION BY series ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING
  AND INTERVAL 1 DAY PRECEDING) AS before FROM s)
SELECT series, date, value > 3 AND before IS NOT NULL AS repaired,
  round(CASE WHEN value > 3 AND before IS NOT NULL THEN before ELSE value END, 6) AS value FROM m""")
def repair_outliers(spark, sf):
    return rounded(X.repair_outliers(series_of(spark, sf), 3.0), "value")


@query("clamp", f"""
WITH {S}, d AS (SELECT series, date, value - lag(value) OVER (PARTITION BY series ORDER BY date) AS value FROM s)
SELECT series, date, CASE WHEN value < 0 THEN 0 ELSE value END AS value FROM d""")
def clamp_query(spark, sf):
    change = F.col("value") - F.lag("value").over(W.partitionBy("series").orderBy("date"))
    return clamp(series_of(spark, sf).withColumn("value", change))


@query("repair_zeros", f"""
WITH RECURSIVE {S}, b AS (SELECT series, min(date) AS lo, max(date) AS hi FROM s GROUP BY 1),
c AS (SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
f AS MATERIALIZED (SELECT c.series, c.date, coalesce(s.value, 0) AS value,
  row_number() OVER (PARTITION BY c.series ORDER BY c.date) AS rn FROM c LEFT JOIN s ON s.series = c.series AND s.date = c.date),
z AS (SELECT series, date, rn, value, CASE WHEN value = 0 THEN 'left' ELSE 'kept' END AS zero_status, [value] AS last
  FROM f WHERE rn = 1
UNION ALL SELECT f.series, f.date, f.rn,
  CASE WHEN f.value = 0 AND z.rn >= 7 THEN list_sum(z.last) / 7 ELSE f.value END,
  CASE WHEN f.value <> 0 THEN 'kept' WHEN z.rn >= 7 THEN 'repaired' ELSE 'left' END,
  list_append(CASE WHEN len(z.last) = 7 THEN z.last[2:] ELSE z.last END,
    CASE WHEN f.value = 0 AND z.rn >= 7 THEN list_sum(z.last) / 7 ELSE f.value END)
  FROM z JOIN f ON f.series = z.series AND f.rn = z.rn + 1)
SELECT series, date, {r('value')} AS value, zero_status FROM z""")
def repair_zeros(spark, sf):
    """Every zero of the full calendar, in date order."""
    return rounded(X.repair_zeros(missing_days(spark, sf)), "value")


@query("grid_best", f"""
WITH {S}, g AS (SELECT CAST(unnest(range(2, 15)) AS INT) AS n, unnest(range(0, 13)) AS grid_id),
p AS (SELECT g.grid_id, g.n, s.series, s.value,
  list(value) OVER (PARTITION BY g.n, s.series ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS past FROM s CROSS JOIN g),
e AS (SELECT series, grid_id, n, sqrt(avg((value - list_avg(past[-n:])) ^ 2)) AS rmse FROM p WHERE len(past) >= 14 GROUP BY 1, 2, 3)
SELECT series, n, round(rmse, 6) AS rmse FROM e
QUALIFY row_number() OVER (PARTITION BY series ORDER BY round(rmse, 9), grid_id) = 1""")
def grid_best(spark, sf):
    """Best length of a moving average per series, scored where all lengths exist."""
    w = W.partitionBy("series").orderBy("date").rowsBetween(-14, -1)
    past = series_of(spark, sf).withColumn("past", F.collect_list("value").over(w)).filter(F.size("past") == 14)
    tried = grid(past, {"n": list(range(2, 15))})
    mean = F.aggregate(F.slice("past", 15 - F.col("n"), F.col("n")), F.lit(0.0), lambda a, x: a + x) / F.col("n")
    rmse = F.round(F.sqrt(F.avg((F.col("value") - mean) * (F.col("value") - mean))), 9)
    scored = tried.groupBy("series", "grid_id", "n").agg(rmse.alias("rmse"))
    return A.best(scored, ["series"], "rmse").select("series", "n", rnd("rmse").alias("rmse"))
