"""Unit-root test against plain least squares."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.operators import unit_root as U


def least_squares(y, lags, start):
    """(statistic, squares left, days) of the regression with ``lags`` lagged changes over the changes after ``start``."""
    dy = np.diff(y)
    x = np.column_stack([y[start:-1], *[dy[start - i:len(dy) - i] for i in range(1, lags + 1)], np.ones(len(dy) - start)])
    beta = np.linalg.lstsq(x, dy[start:], rcond=None)[0]
    left = ((dy[start:] - x @ beta) ** 2).sum()
    free = len(dy) - start - x.shape[1]
    return beta[0] / math.sqrt(left / free * np.linalg.inv(x.T @ x)[0, 0]) if free > 0 else None, left, len(dy) - start


def brute(y, most=None):
    n = len(y)
    most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2) if most is None else most
    aic = [(m * math.log(left / m) + 2 * k, k) for k in range(most + 1) for _, left, m in [least_squares(y, k, most)]]
    lags = min(aic)[1]
    return least_squares(y, lags, lags)[0], lags, n - 1 - lags


@pytest.fixture(scope="module")
def walks():
    r = np.random.default_rng(3)
    week = 40 * np.sin(np.arange(300) * 2 * np.pi / 7)
    return {
        "walk": np.cumsum(r.normal(size=160)),
        "short": np.cumsum(r.normal(size=21)) + 5,
        "noise": r.normal(size=131) * 3 + 1e5,
        "week": np.round(week + r.normal(size=300) * 4),
        "total": np.cumsum(1e3 + np.cumsum(r.normal(size=200)) * 50),
    }


def test_against_least_squares(series, walks):
    found = {(x.series, x.d): x for x in U.adf(series(**walks), d=(0, 1, 2)).collect()}
    assert len(found) == 15
    for k, y in walks.items():
        for d in range(3):
            stat, lags, used = brute(np.diff(y, d))
            x = found[k, d]
            assert (x.lags, x.n_used) == (lags, used), (k, d)
            assert x.statistic == pytest.approx(stat, rel=1e-6), (k, d)


@pytest.mark.parametrize("most", [0, 1, 5])
def test_given_lags(series, walks, most):
    for x in U.adf(series(**walks), d=(0,), max_lag=most).collect():
        stat, lags, used = brute(walks[x.series], most)
        assert (x.lags, x.n_used) == (lags, used)
        assert x.statistic == pytest.approx(stat, rel=1e-6)


def test_nulls_are_left_out(series, walks):
    gaps = [v for x in walks["walk"] for v in (x, None)]
    a, b = U.adf(series(a=list(walks["walk"]), b=gaps), d=(0,)).orderBy("series").collect()
    assert a.statistic == b.statistic and (a.lags, a.n_used, a.p) == (b.lags, b.n_used, b.p)


def test_without_a_statistic(series):
    df = series(constant=[4] * 30, five=[1, 5, 2, 8, 3], line=list(range(40)), one=[3], none=[None, None])
    found = {(x.series, x.d): x for x in U.adf(df).collect()}
    assert {k for k, _ in found} == {"constant", "five", "line", "one"}  # a series without a value has no row
    assert len(found) == 16
    assert all(x.statistic is None and x.p is None for x in found.values())
    assert U.adf(df.limit(0)).collect() == []


def test_repeated_days_and_other_columns(spark, series):
    df = series(a=[1, 4, 2, 8, 5, 7, 1, 3, 9, 2, 6, 4]).withColumn("u", F.lit(1)).withColumn("d", F.lit("x"))
    once = U.adf(df, d=(0,)).first()
    assert once.statistic == pytest.approx(brute(np.array([1, 4, 2, 8, 5, 7, 1, 3, 9, 2, 6, 4.0]))[0])
    assert U.adf(df.unionAll(df), d=(0,)).first().n_used + 1 + U.adf(df.unionAll(df), d=(0,)).first().lags == 24


def test_p_of_published_points(spark):
    at = spark.createDataFrame([(-2.86,), (-3.43,), (3.0,), (-19.0,), (None,)], "s double")
    p = [x.p for x in at.select(U.adf_p(F.col("s")).alias("p")).collect()]
    assert p[0] == pytest.approx(0.05, abs=2e-3)
    assert p[1] == pytest.approx(0.01, abs=1e-3)
    assert p[2:] == [1.0, 0.0, None]


def test_no_python_but_for_the_tail(series, walks):
    plan = U.adf(series(**walks))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and plan.count("ArrowEvalPython") == 1
