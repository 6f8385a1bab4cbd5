"""The additive model against one dense ridge regression per series and cut-off."""

from datetime import date, timedelta

import numpy as np
import pytest

from tallycast.operators import additive as M

START = date(2020, 3, 1)


def design(day, start, span, yearly):
    t = (day - start) / span
    cols = [np.ones(len(day)), t, *[np.maximum(t - 0.8 * j / 25, 0) for j in range(1, 26)]]
    for period, order, days in ((7, 3, 14), (365.25, 10, 730))[: 1 + yearly]:
        for f in (np.sin, np.cos):
            cols += [f(2 * np.pi * k * day / period) * (span >= days) for k in range(1, order + 1)]
    return np.column_stack(cols)


def ridge(x, y, seen, scale=0.05, season=10.0):
    """Coefficients; the priors enter as rows of their own."""
    on = np.ones(x.shape[1])
    on[2:27] = [0.8 * j / 25 <= 0.8 * seen + 1e-9 for j in range(1, 26)]
    noise = max(np.var(y / np.abs(y).max()), 1e-10)
    sd = np.r_[[5.0, 5.0], np.full(25, scale), np.full(x.shape[1] - 27, season)]
    both = np.vstack([x * on, np.diag(np.sqrt(noise) / sd)])
    return np.linalg.lstsq(both, np.r_[y, np.zeros(x.shape[1])], rcond=None)[0] * on


def numbers(n, seed):
    t = np.arange(n)
    r = np.random.default_rng(seed)
    return 50 + 0.1 * t + 8 * np.sin(2 * np.pi * t / 7) + np.cumsum(r.normal(size=n)) + 20 * np.cos(2 * np.pi * t / 365.25)


@pytest.mark.parametrize("n,yearly", [(900, True), (900, False), (60, True), (10, True), (2, True)])
def test_fit_is_a_ridge_regression(series, n, yearly):
    y = numbers(n, n)
    day = np.arange(n) + (START - date(1970, 1, 1)).days
    x = design(day, day[0], max(n - 1, 1), yearly)
    s = series(a=y)
    found = M.predict_additive(M.fit_additive(s, yearly=yearly), M.future_frame(s, 5, True)).orderBy("date").collect()
    ahead = design(np.arange(n + 5) + day[0], day[0], max(n - 1, 1), yearly)
    beta = ridge(x, y, 1.0)
    assert [r.yhat for r in found] == pytest.approx(ahead @ beta, abs=1e-5)
    assert [r.weekly for r in found] == pytest.approx(ahead[:, 27:33] @ beta[27:33], abs=1e-5)


def test_cutoffs_with_gaps(series):
    """Days are missing over whole steps between cut-offs."""
    y = numbers(240, 7)
    gone = (np.arange(240) % 50 > 15) & (np.arange(240) > 60) | (np.arange(240) % 9 == 4)
    s = series(a=[None if g else v for v, g in zip(y, gone)])
    params = {"changepoint_prior_scale": [0.01, 0.5], "seasonality_prior_scale": [0.1, 10.0]}
    found = {(r.cutoff, r.date, r.grid_id): r for r in M.cross_validate(s, params, horizon=20, period=6, yearly=False).collect()}
    seen = np.flatnonzero(~gone)
    day = seen + (START - date(1970, 1, 1)).days
    lo, hi, want = seen[0], seen[-1], 0
    x = design(day, day[0], hi - lo, False)
    cut = hi - 20
    while cut >= lo + 60:
        train, ahead = seen <= cut, (seen > cut) & (seen <= cut + 20)
        for g, (c, w) in enumerate((c, w) for c in (0.01, 0.5) for w in (0.1, 10.0)):
            beta = ridge(x[train], y[seen[train]], (cut - lo) / (hi - lo), c, w)
            for at, f in zip(seen[ahead], x[ahead] @ beta):
                r = found[START + timedelta(days=int(cut)), START + timedelta(days=int(at)), g]
                assert r.forecast == pytest.approx(f, abs=1e-5) and r.observed == y[at] and r.h == at - cut
                assert (r.changepoint_prior_scale, r.seasonality_prior_scale) == (c, w) and r.yhat_lower <= r.forecast <= r.yhat_upper
                want += 1
        cut -= 6
    assert len(found) == want > 400


def test_short_null_and_empty_series(spark, series):
    s = series(one=[3], none=[None, None], flat=[4] * 20, zero=[0] * 20)
    fits = M.fit_additive(s)
    assert {r.series for r in fits.collect()} == {"flat", "zero"}
    found = {(r.series, round(r.yhat, 3)) for r in M.predict_additive(fits, M.future_frame(s.filter("value is not null"), 3)).collect()}
    assert found == {("flat", 4.0), ("zero", 0.0)}
    assert M.fit_additive(s.limit(0)).collect() == [] and M.cross_validate(s, horizon=7).count() == 0


def test_other_columns_and_repeated_days(series):
    s = series(a=numbers(60, 1))
    more = s.withColumn("grid_id", s.value).withColumn("_day", s.value).withColumn("trend", s.value)
    plain, twice = M.fit_additive(s).first(), M.fit_additive(more.unionAll(more)).first()
    assert len(plain.b_trend) == len(twice.b_trend) == 27
    # twice the days weigh twice against the priors: the same model with half the noise
    assert twice.sigma <= plain.sigma + 1e-9


def test_too_many_event_names(spark, series, monkeypatch):
    monkeypatch.setattr(M, "MOST_EVENTS", 3)
    events = spark.createDataFrame([("a", START, f"e{i}") for i in range(4)], "series string, date date, event string")
    with pytest.raises(ValueError):
        M.fit_additive(series(a=numbers(30, 1)), None, events)


def test_products_are_summed_before_the_shuffle(series):
    plan = M.fit_additive(series(a=numbers(60, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "MapInPandas" not in plan and "CartesianProduct" not in plan
