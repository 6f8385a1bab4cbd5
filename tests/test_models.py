"""Fits recover known parameters; forecasts obey their recursions."""

from datetime import date, timedelta
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.operators import additive as M
from tallycast.operators import arima as R
from tallycast.operators.likelihood import autocovariance, whiten
from tallycast.plans import prepare_series, train_models
from tallycast.plans.training import training_table


def arma(n, ar=(), ma=(), seed=0):
    rng = np.random.default_rng(seed)
    e, y = rng.normal(size=n + 300), np.zeros(n + 300)
    for t in range(n + 300):
        y[t] = e[t] + sum(a * y[t - i - 1] for i, a in enumerate(ar) if t > i) + sum(b * e[t - j - 1] for j, b in enumerate(ma) if t > j)
    return y[300:]


CASES = [
    ((1, 0, 0), {"ar": (0.7,)}, "ar", [0.7]),
    ((0, 0, 2), {"ma": (0.6, 0.3)}, "ma", [0.6, 0.3]),
    ((1, 1, 1), {"ar": (0.5,), "ma": (0.3,)}, "ar", [0.5]),
    ((1, 0, 0, 1, 0, 0, 7), {"ar": (0.4, 0, 0, 0, 0, 0, 0.5, -0.2)}, "sar", [0.5]),
    ((0, 1, 1, 0, 1, 1, 7), {"ma": (-0.4, 0, 0, 0, 0, 0, -0.5, 0.2)}, "sma", [-0.5]),
]


@pytest.mark.parametrize("order,truth,name,want", CASES)
def test_recovery(order, truth, name, want):
    order = tuple([*order, *([0] * (7 - len(order)))])
    y = arma(3000, **truth)
    if order[4]:
        for t in range(7, len(y)):
            y[t] += y[t - 7]
    y = np.cumsum(y) if order[1] else y + 4
    found = R.fit_series(y, order)
    assert found["status"] == "ok"
    assert np.asarray(found[name]) == pytest.approx(want, abs=0.08)
    assert found["sigma2"] == pytest.approx(1, abs=0.1)
    if not order[1]:
        assert found["mean"] == pytest.approx(4, abs=0.6)


@pytest.mark.parametrize("ar,ma", [((0.6,), (0.4,)), ((0.5, -0.3), ()), ((), (0.5, 0.2, -0.3)), ((0.2, 0, 0.4), (0.7,)), ((), ())])
def test_whitening_is_the_exact_likelihood(ar, ma):
    a, b = np.r_[1, -np.asarray(ar)], np.r_[1.0, ma]
    x = arma(60, ar, ma, 7)
    psi = R._times(R._inverse(a, 4000), b, 4000)
    gamma = np.array([psi[:len(psi) - h] @ psi[h:] for h in range(60)])
    assert autocovariance(a, b, 12) == pytest.approx(gamma[:12], abs=1e-9)
    full = gamma[np.abs(np.subtract.outer(np.arange(60), np.arange(60)))]
    z, logdet = whiten(x, a, b)
    assert logdet == pytest.approx(np.linalg.slogdet(full)[1], abs=1e-8)
    assert z @ z == pytest.approx(x @ np.linalg.solve(full, x))


def test_exact_fit_is_a_maximum():
    y = arma(90, (0.6,), (0.4,), 11) + 3
    order = (1, 0, 1, 0, 0, 0, 0)
    css, exact = R.fit_series(y, order), R.fit_series(y, order, "exact")

    def loglik(phi, theta, mean, sigma2):
        z, logdet = whiten(y - mean, np.array([1, -phi]), np.array([1, theta]))
        return -0.5 * (len(y) * np.log(2 * np.pi * sigma2) + logdet + z @ z / sigma2)

    best = (exact["ar"][0], exact["ma"][0], exact["mean"], exact["sigma2"])
    top = loglik(*best)
    assert exact["loglik"] == pytest.approx(top)
    assert top >= loglik(css["ar"][0], css["ma"][0], css["mean"], css["sigma2"])
    for i in range(4):
        for step in (-0.02, 0.02):
            moved = list(best)
            moved[i] += step
            assert loglik(*moved) < top
    seasonal = R.fit_series(np.cumsum(arma(120, (0.3,), (), 5)), (1, 1, 1, 1, 0, 0, 7), "exact")
    assert seasonal["status"] == "ok" and np.isfinite(seasonal["aic"])


def test_residuals_match_the_recursion():
    model = R.Model(SimpleNamespace(d=1, sd=0, m=0, ar=[0.4], ma=[0.3, -0.2], sar=[], sma=[], mean=0.0, sigma2=1.0))
    y = np.cumsum(arma(80, (0.4,), (0.3,)))
    w, e = np.diff(y), np.zeros(80)
    for t in range(2, 80):
        e[t] = w[t - 1] - 0.4 * w[t - 2] - 0.3 * e[t - 1] + 0.2 * e[t - 2]
    assert model.residuals(y) == pytest.approx(e, abs=1e-9)
    # An origin that sees all rows, and one that sees its last 30 only.
    paths = model.origins(y, np.array([40, 79]), 3, None)
    f1 = 0.4 * (y[40] - y[39]) + 0.3 * e[40] - 0.2 * e[39]
    assert paths[0, 0] == pytest.approx(y[40] + f1)
    alone = model.origins(y[50:], np.array([29]), 3, None)[0]
    assert model.origins(y, np.array([79]), 3, 30)[0] == pytest.approx(alone)


def test_power_series():
    poly = np.array([1.0, 0.4, -0.2, 0.1])
    g = R._inverse(poly, 500)
    assert R._times(poly, g, 500) == pytest.approx(np.r_[1, np.zeros(499)], abs=1e-12)


def test_unfinished_fits_do_not_win(spark, series):
    y = np.cumsum(arma(300, (0.3,)))
    assert R.fit_series(y, (3, 0, 3, 0, 0, 0, 0), steps=2)["status"] == "unfinished"
    assert R.fit_series(y, (1, 1, 0, 0, 0, 0, 0))["status"] == "ok"
    fits = R.fit_arima(series(a=y), [(1, 1, 0), (0, 1, 1)])
    assert {r.status for r in fits.collect()} == {"ok"}


def test_interval_of_a_random_walk():
    model = R.Model(SimpleNamespace(d=1, sd=0, m=0, ar=[], ma=[], sar=[], sma=[], mean=0.0, sigma2=4.0))
    assert model.spread(4) == pytest.approx(2 * np.sqrt([1, 2, 3, 4]))


def test_forecast_rows_and_origin(spark, series):
    s = series(a=arma(200, (0.5,)) + 10, b=arma(40, (0.5,)) + 10, c=[1.0])
    models = R.fit_arima(s, [(1, 0, 0)])
    status = {r.series: r.status for r in models.collect()}
    assert status == {"a": "ok", "b": "ok", "c": "too_short"}
    f = R.forecast(s, models, 5)
    assert f.filter("h is not null").count() == 10
    none = f.filter("h is null").collect()  # the series without a model says so
    assert [(r.series, r.forecast) for r in none] == [("c", None)]
    assert [(r.series, r.forecast) for r in R.fitted(s, models).filter("date is null").collect()] == [("c", None)]
    assert [(r.series, r.forecast) for r in R.backtest(s, models).filter("origin is null").collect()] == [("c", None)]
    early = R.forecast(s, models, 2, origin="2020-03-20").filter("h is not null").collect()
    assert {(r.forecast_date, r.forecasted_date) for r in early} == {
        (date(2020, 3, 20), date(2020, 3, 21)), (date(2020, 3, 20), date(2020, 3, 22))
    }
    row = f.filter((F.col("series") == "a") & (F.col("h") == 1)).first()
    assert row.mean_ci_lower < row.forecast < row.mean_ci_upper


def test_backtest_rows(spark, series):
    s = series(a=arma(60) + 5)
    m = R.fit_ar(s, 1)
    assert R.backtest(s, m, 7, 50, False).count() == (60 - 50) * 7
    assert R.backtest(s, m, 7, 50, True).count() == (60 - 50 + 1) * 7
    spine = s.select("date").limit(5)
    assert R.backfill(s, m, spine, 3).count() == 15


def test_ar_orders_agree(spark, series):
    s = series(a=arma(400, (0.5, -0.2)) + 3)
    one, three = R.fit_ar(s, 1).first(), R.fit_ar(s, 3).first()
    css = R.fit_arima(s, [(3, 0, 0)]).first()
    assert three.ar == pytest.approx(css.ar, abs=1e-4)
    assert three.sigma2 == pytest.approx(css.sigma2, rel=1e-3)
    assert len(one.ar) == 1 and one.p == 1


def test_orders_per_series_and_search(spark, series):
    s = series(a=np.cumsum(arma(300, (0.6,))), b=arma(300, (), (0.7,)))
    orders = spark.createDataFrame([("a", 1, 1, 0), ("b", 0, 0, 1)], "series string, p int, d int, q int")
    found = {r.series: r for r in R.fit_arima(s, orders).collect()}
    assert found["a"].ar == pytest.approx([0.6], abs=0.12)
    assert found["b"].ma == pytest.approx([0.7], abs=0.12)
    best = {r.series: (r.p, r.q) for r in R.search_orders(s, R.order_grid(p=(0, 1), q=(0, 1))).collect()}
    assert best["b"][1] == 1


def test_orders_are_compared_on_the_same_rows():
    y = arma(200, (0.5,))
    full = R.fit_series(y, (1, 0, 0, 0, 0, 0, 0))
    late = R.fit_series(y, (1, 0, 0, 0, 0, 0, 0), compare_from=20)
    assert late["ar"] == pytest.approx(full["ar"]) and late["loglik"] != pytest.approx(full["loglik"])
    assert R.fit_series(y, (1, 0, 0, 0, 0, 0, 0), compare_from=200)["status"] == "too_short"


def test_stepwise_search(spark, series):
    s = series(a=np.cumsum(arma(250, (0.7,), (), 3)), b=np.cumsum(arma(250, (), (0.8,), 4)), c=[1.0, 2.0])
    found = {r.series: r for r in R.search_stepwise(s, d=1, limit=3).collect()}
    assert found["a"].p >= 1 and found["b"].q >= 1
    single = {r.series: r.aic for r in R.fit_arima(s, [(1, 1, 0)], method="exact").collect()}
    assert found["a"].aic <= single["a"] + 1e-6
    assert found["c"].status == "too_short"
    week = R.search_stepwise(series(w=np.tile([5.0, 1, 2, 8, 3, 9, 4], 20) + arma(140, seed=8) * 0.3), d=0, sd=1, m=7, limit=1).first()
    assert (week.sd, week.m) == (1, 7)


def test_training_job(spark):
    start = date(2020, 2, 20)
    rng = np.random.default_rng(2)
    rows = []
    for code in ("AR", "CH", "EC", "ES", "MX"):
        y = np.maximum(np.round(np.linspace(50, 900, 150) + rng.normal(size=150) * 20), 1)
        if code == "CH":
            y[60], y[80] = 40000, 0
        if code == "ES":
            y[70] = -30
        rows += [(code, start + timedelta(days=i), float(v)) for i, v in enumerate(y)]
    s = spark.createDataFrame(rows, "series string, date date, value double")
    table = training_table(spark)
    ready = prepare_series(s, table)
    counts = {r.series: r["count"] for r in ready.groupBy("series").count().collect()}
    assert counts == {"AR": 92, "CH": 93, "EC": 88, "ES": 103, "MX": 88}
    low, high = ready.agg(F.min("value"), F.max("value")).first()
    assert low >= 50 and high < 2000
    models = {r.series: r for r in train_models(s, table).collect()}
    assert {k: (m.p, m.d, m.q) for k, m in models.items()} == {
        "AR": (2, 2, 7), "MX": (1, 1, 1), "CH": (1, 1, 3), "EC": (1, 1, 1), "ES": (2, 1, 2)
    }
    assert {m.status for m in models.values()} <= {"ok", "unfinished"} and sum(m.status == "ok" for m in models.values()) >= 3


# ---- additive ------------------------------------------------------------------------


def weekly(n=200, noise=0.1, seed=4):
    t = np.arange(n)
    return 20 + 0.2 * t + 3 * np.sin(2 * np.pi * t / 7) + np.random.default_rng(seed).normal(size=n) * noise


def test_additive_recovers_trend_and_week(spark, series):
    s = series(a=weekly())
    f = M.predict_additive(M.fit_additive(s), M.future_frame(s, 14)).orderBy("date").collect()
    t = np.arange(200, 214)
    want = 20 + 0.2 * t + 3 * np.sin(2 * np.pi * t / 7)
    assert [r.yhat for r in f] == pytest.approx(want, abs=0.5)
    assert all(r.yhat_lower < r.yhat < r.yhat_upper for r in f)
    assert [r.yhat for r in f] == pytest.approx([r.trend + r.weekly + r.yearly + r.events for r in f])


def test_events_explain_their_days(spark, series):
    y = weekly(noise=0.01)
    y[100:110] += 15
    s = series(a=y)
    day = lambda i: date(2020, 3, 1) + timedelta(days=i)
    windows = spark.createDataFrame([("a", day(100), day(109), "stop")], "series string, start date, end date, event string")
    events = M.event_days(windows)
    assert events.count() == 10
    f = M.predict_additive(M.fit_additive(s, None, events), s, events)
    inside = f.filter(F.col("date").between(day(100), day(109))).agg(F.avg("events")).first()[0]
    assert inside == pytest.approx(15, abs=1)
    assert f.filter(~F.col("date").between(day(100), day(109))).agg(F.max(F.abs("events"))).first()[0] == 0


def test_cross_validation_cutoffs(spark, series):
    s = series(a=weekly(100))
    cuts = [r.cutoff for r in M.cutoffs(s, 7).orderBy("cutoff").collect()]
    last = date(2020, 3, 1) + timedelta(days=99 - 7)
    assert cuts[-1] == last and (cuts[1] - cuts[0]).days == 3 and cuts[0] >= date(2020, 3, 22)
    cv = M.cross_validate(s, horizon=7)
    assert cv.count() == len(cuts) * 7
    assert M.cutoffs(series(b=weekly(20)), 7).count() == 0


def test_tuning_prefers_the_better_scale(spark, series):
    t = np.arange(240)
    y = np.where(t < 120, t * 1.0, 120 - (t - 120) * 2.0) + 100 + np.random.default_rng(1).normal(size=240) * 0.2
    best = M.tune(series(a=y), {"changepoint_prior_scale": [0.0001, 0.5]}, horizon=14, period=20).first()
    assert best.changepoint_prior_scale == 0.5
