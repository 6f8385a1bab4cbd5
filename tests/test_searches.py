"""The registered searches go through the whole of their grids."""

import numpy as np
import pytest
from conftest import SF

from tallycast.checks import QUERIES, forecasts
from tallycast.operators import aggregates as A
from tallycast.operators.likelihood import autocovariance, whiten


def test_order_stepwise_is_weekly(spark):
    found = QUERIES["order_stepwise"](spark, SF).collect()
    assert len(found) == 5 and {(r.d, r.sd, r.m) for r in found} == {(1, 1, 7)} and min(r.n_obs for r in found) > 200


def test_tune_takes_the_best_of_the_whole_grid(spark):
    got = {r.series: r for r in QUERIES["tune"](spark, SF).collect()}
    scored = A.score(forecasts.additive.cross_validate(
        forecasts.series_of(spark, SF), forecasts._GRID, 30, yearly=False), ["series", "grid_id", *forecasts._GRID]).collect()
    assert len(got) == 5 and len(scored) == 5 * 16
    for k, r in got.items():
        assert r.rmse == pytest.approx(min(x.rmse for x in scored if x.series == k), abs=1e-6)


def test_cross_validate_takes_every_cutoff(spark):
    want = {r["series"]: r["count"] for r in QUERIES["cutoffs"](spark, SF).groupBy("series").count().collect()}
    got = QUERIES["cross_validate"](spark, SF).groupBy("series").agg({"n": "sum"}).collect()
    days = {r["series"]: r["count"] for r in QUERIES["cutoffs"](spark, SF).join(
        forecasts.series_of(spark, SF).withColumnRenamed("date", "day"), "series").filter("day > cutoff and day <= cutoff + 30").groupBy("series").count().collect()}
    assert {r[0]: r[1] for r in got} == days and min(want.values()) > 100


@pytest.mark.parametrize("n", [3, 16, 17, 90])
def test_whitening_by_blocks(n):
    ar, ma = np.convolve([1, -0.4], np.r_[1, np.zeros(6), -0.5])[: n - 1], np.convolve([1, 0.3], np.r_[1, np.zeros(20), -0.6])
    gamma = autocovariance(ar, ma, n)
    factor = np.linalg.cholesky(gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))])
    x = np.random.default_rng(n).normal(size=n)
    z, logdet = whiten(x, ar, ma)
    assert np.allclose(z @ z, (e := np.linalg.solve(factor, x)) @ e) and np.isclose(logdet, 2 * np.log(np.diag(factor)).sum())
