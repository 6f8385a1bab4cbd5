"""Statistics against brute force on small series."""

import math

import numpy as np
import pytest

from tallycast.operators import aggregates as A
from tallycast.operators import stats as Z
from tallycast.operators import wavelet as V


@pytest.fixture(scope="module")
def noise():
    rng = np.random.default_rng(3)
    return {k: np.round(np.cumsum(rng.normal(size=n)) * 3, 0) for k, n in (("a", 160), ("b", 131))}


@pytest.fixture
def frame(noise, series):
    return series(**noise)


def rows(df, key="series"):
    return {r[key]: r for r in df.collect()}


def test_mann_kendall(frame, noise):
    found = rows(Z.mann_kendall(frame))
    for k, x in noise.items():
        n = len(x)
        pairs = [(x[j] - x[i], j - i) for i in range(n) for j in range(i + 1, n)]
        s = sum(np.sign(d) for d, _ in pairs)
        assert found[k].s == s
        assert found[k].slope == pytest.approx(np.median([d / g for d, g in pairs]))
        assert found[k].intercept == pytest.approx(np.median(x) - np.median(np.arange(n)) * found[k].slope)
        assert found[k].p == pytest.approx(math.erfc(abs(found[k].z) / math.sqrt(2)))


def test_slope_median_in_little_memory(noise):
    for x in [*noise.values(), np.zeros(50), np.arange(60.0), np.r_[np.zeros(40), 5.0]]:
        want = np.median([(x[j] - x[i]) / (j - i) for i in range(len(x)) for j in range(i + 1, len(x))])
        assert Z._slope_median(x, room=40, draws=5000) == pytest.approx(want, abs=1e-9)


def test_slope_median_of_many_days():
    r = np.random.default_rng(3)
    for x in [np.cumsum(r.normal(size=3000)), r.integers(0, 9, 3000).astype(float), np.where(np.arange(3000) < 2900, 0.0, 7.0)]:
        want = np.median(np.concatenate([(x[i + 1:] - x[i]) / np.arange(1, len(x) - i) for i in range(len(x) - 1)]))
        assert Z._slope_median(x, room=20_000) == pytest.approx(want, abs=1e-9)
    assert Z._slope_median(np.arange(100_000) * 0.25) == pytest.approx(0.25)


def test_describe_quartiles_are_exact(spark):
    r = np.random.default_rng(4)
    groups = {
        "ties": r.integers(0, 5, 4000).astype(float), "wide": r.normal(size=6001) * 1e6, "one": np.array([2.5]),
        "two": np.array([1.0, 4.0]), None: r.exponential(size=777), "none": np.array([]),
    }
    rows = [(k, float(v), int(v)) for k, x in groups.items() for v in x] + [("none", None, None), ("ties", None, None)]
    df = spark.createDataFrame(rows, "k string, x double, i int").repartition(7)
    for accuracy in (20, 10_000):
        found = {row["k"]: row for row in A.describe(df, ["k"], ["x", "i"], accuracy).collect()}
        assert set(found) == set(groups)
        for k, x in groups.items():
            assert found[k]["x_count"] == len(x)
            for c, values in (("x", x), ("i", x.astype(int))):
                got = [found[k][f"{c}_{q}"] for q in A.QUARTILES]
                want = [np.quantile(values, p) for p in A.QUARTILES.values()] if len(x) else [None] * 3
                assert got == want or got == pytest.approx(want, rel=1e-12)
    assert A.describe(df.limit(0), ["k"], ["x"]).collect() == []
    assert A.describe(df, [], ["x"]).first()["x_q50"] == pytest.approx(np.median(np.concatenate(list(groups.values()))))


def test_mann_whitney(frame, noise):
    found = rows(Z.mann_whitney(frame, 60))
    for k, x in noise.items():
        a, b = x[:60], x[60:]
        u = sum((p > q) + 0.5 * (p == q) for p in a for q in b)
        assert found[k].statistic == u
        assert 0 <= found[k].p <= 1


def test_rank_sum_of_few_values(series):
    from itertools import combinations

    values = [3.0, 9.0, 1.0, 8.0, 2.0, 7.0, 4.0]
    us = [sum(values[i] > values[j] for i in c for j in range(7) if j not in c) for c in combinations(range(7), 3)]
    seen = us[0]
    want = min(1.0, 2 * sum(u >= max(seen, 12 - seen) for u in us) / len(us))
    row = Z.mann_whitney(series(a=values), 3).first()
    assert (row.statistic, row.p) == (seen, pytest.approx(want))
    assert Z.mann_whitney(series(a=[1, 2]), 2).first().p is None


def test_bartlett_more_slices(frame, noise):
    found = rows(Z.bartlett(frame, (30, 60, 90)))
    for k, x in noise.items():
        parts = [x[:30], x[30:60], x[60:90], x[90:]]
        n = np.array([len(p) - 1 for p in parts])
        v = np.array([p.var(ddof=1) for p in parts])
        t = n.sum() * math.log((n * v).sum() / n.sum()) - (n * np.log(v)).sum()
        t /= 1 + ((1 / n).sum() - 1 / n.sum()) / 9
        assert found[k].statistic == pytest.approx(t)
        grid = np.linspace(t, t + 400, 400001)
        tail = np.trapezoid(np.sqrt(grid) * np.exp(-grid / 2), grid) / (2**1.5 * math.gamma(1.5))
        assert found[k].p == pytest.approx(tail, rel=1e-4, abs=1e-12)


def test_pacf_is_the_last_regression_coefficient(frame, noise):
    found = {(r.series, r.lag): r.pacf for r in Z.pacf(frame, 6).collect()}
    for k, x in noise.items():
        d = x - x.mean()
        c = np.array([(d[h:] * d[:len(d) - h]).sum() for h in range(7)])
        for h in range(1, 7):
            toeplitz = c[np.abs(np.subtract.outer(np.arange(h), np.arange(h)))]
            assert found[k, h] == pytest.approx(np.linalg.solve(toeplitz, c[1:h + 1])[-1])


def test_lags_beyond_a_short_series(series):
    df = series(a=[1, 5, 2, 8])
    assert sorted(r.lag for r in Z.acf(df, 10).collect()) == [0, 1, 2, 3]
    assert sorted(r.lag for r in Z.pacf(df, 10).collect()) == [0, 1, 2, 3]


def test_periodogram_peak(series):
    t = np.arange(140)
    df = Z.periodogram(series(a=10 + 3 * np.sin(2 * np.pi * t / 7)))
    peak = df.orderBy(df.amplitude.desc()).first()
    assert peak.period == pytest.approx(7)


def test_wavelet_against_convolution(series):
    rng = np.random.default_rng(5)
    x = rng.normal(size=200)
    scales, periods, wave = V.transform(x, 1.0, 0.25, 3)
    k = int(np.searchsorted(periods, 8))
    s = scales[k]
    for t in (70, 100, 131):
        u = (np.arange(200) - t) / s
        want = (x * np.sqrt(1 / s) * np.pi**-0.25 * np.exp(-1j * 6 * u) * np.exp(-u**2 / 2)).sum()
        assert abs(wave[k, t]) == pytest.approx(abs(want), rel=1e-3)


def test_wavelet_finds_the_week(series):
    t = np.arange(256)
    df = series(a=np.sin(2 * np.pi * t / 7) + 0.01 * np.cos(t))
    spectrum = V.global_spectrum(df, dt=1.0).toPandas()
    top = spectrum.loc[spectrum["power"].idxmax()]
    assert top["period"] == pytest.approx(7, rel=0.06)
    assert top["power"] > 0.5 * top["bound95"]  # a pure wave is red noise of its own lag
    power = V.wavelet_power(df, dt=1.0)
    assert power.count() == 256 * 73
    assert power.filter("inside_cone").count() < 256 * 73


def test_chi2_95():
    assert V.chi2_95(np.array([2.0, 10.0])) == pytest.approx([-2 * math.log(0.05), 18.307038], rel=0.01)


def test_lag1_of_red_noise():
    rng = np.random.default_rng(1)
    x = np.zeros(5000)
    for i in range(1, 5000):
        x[i] = 0.6 * x[i - 1] + rng.normal()
    assert V.lag1(x) == pytest.approx(0.6, abs=0.04)
