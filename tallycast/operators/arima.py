"""(Seasonal) ARIMA for any number of series.

Estimation is by conditional sum of squares with analytic derivatives; every
filter is a product of power series, so a step is a few FFTs and has no loop
over days. ``method="exact"`` goes on from there to the exact likelihood, which
costs a loop over the days per evaluation. Fixed parameters are applied to new
data with no refit.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .aggregates import best
from .likelihood import whiten
from .packed import key_field, map_rows, pack, to_dates
from .shape import up_to
from .windows import last_n

# Seasonal orders are sp, sd and sq: Spark column names ignore case.
ORDER = ["p", "d", "q", "sp", "sd", "sq", "m"]
MODEL_FIELDS = (
    "grid_id int, p int, d int, q int, sp int, sd int, sq int, m int, mean double, ar array<double>, ma array<double>, "
    "sar array<double>, sma array<double>, sigma2 double, loglik double, aic double, bic double, n_obs long, status string"
)

# ---- power series -------------------------------------------------------------


def _times(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """First n terms of the product."""
    if min(len(a), len(b)) <= 32:
        return np.convolve(a, b)[:n]
    size = 1 << (len(a) + len(b) - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(a, size) * np.fft.rfft(b, size), size)[:min(n, len(a) + len(b) - 1)]


def _inverse(poly: np.ndarray, n: int) -> np.ndarray:
    """First n terms of 1 / poly (poly[0] = 1), doubling the exact terms each step."""
    g = np.ones(1)
    while len(g) < n:
        m = min(2 * len(g), n)
        rest = np.zeros(m)
        prod = _times(poly[:m], g, m)
        rest[:len(prod)] = -prod
        rest[0] += 2
        g = _times(g, rest, m)
    return g


def _filter(response: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _times(response, x, len(x))


def _apply(poly: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.convolve(poly, x)[:len(x)]


def _poly(coef, step: int, sign: int) -> np.ndarray:
    """1 + sign * (c1 B^step + c2 B^2step + ..)."""
    out = np.zeros(len(coef) * step + 1)
    out[0] = 1
    if len(coef):
        out[step::step] = sign * np.asarray(coef, dtype=float)
    return out


def _inside(coef, sign: int) -> bool:
    """All roots of the lag polynomial lie outside the unit circle."""
    if not len(coef):
        return True
    return bool(np.abs(np.roots(_poly(coef, 1, sign)[::-1])).min(initial=np.inf) > 1.0005)


def _differenced(y: np.ndarray, d: int, D: int, m: int) -> np.ndarray:
    w = np.diff(y, d)
    for _ in range(D):
        w = w[m:] - w[:-m]
    return w


def _shift(x: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(x)
    if k < len(x):
        out[k:] = x[:len(x) - k]
    return out


# ---- estimation -----------------------------------------------------------------


def _unpack(theta, p, q, P, Q):
    ar, ma, sar, sma = np.split(theta[:p + q + P + Q], np.cumsum([p, q, P]))
    return ar, ma, sar, sma, (theta[-1] if len(theta) > p + q + P + Q else 0.0)


def _full(theta, order):
    """Whole AR and MA polynomials, and the mean."""
    p, _, q, P, _, Q, m = order
    ar, ma, sar, sma, mean = _unpack(theta, p, q, P, Q)
    step = m or 1
    return np.convolve(_poly(ar, 1, -1), _poly(sar, step, -1)), np.convolve(_poly(ma, 1, 1), _poly(sma, step, 1)), mean


def _feasible(ar, ma, sar, sma) -> bool:
    return _inside(ar, -1) and _inside(sar, -1) and _inside(ma, 1) and _inside(sma, 1)


def _residual(w, theta, order, jacobian=False):
    p, _, q, P, _, Q, m = order
    ar, ma, sar, sma, mean = _unpack(theta, p, q, P, Q)
    a, s = _poly(ar, 1, -1), _poly(sar, m or 1, -1)
    b, t = _poly(ma, 1, 1), _poly(sma, m or 1, 1)
    full = np.convolve(a, s)
    r, n = len(full) - 1, len(w)
    x = w - mean
    ma_response = _inverse(np.convolve(b, t), n)

    def out(u):
        u = u.copy()
        u[:r] = 0
        return _filter(ma_response, u)

    e = out(_apply(full, x))
    if not jacobian:
        return e, None, r
    cols = []
    part = _apply(s, x)
    cols += [out(-_shift(part, i)) for i in range(1, p + 1)]
    part = _filter(_inverse(b, n), e)
    cols += [-_shift(part, j) for j in range(1, q + 1)]
    part = _apply(a, x)
    cols += [out(-_shift(part, i * m)) for i in range(1, P + 1)]
    part = _filter(_inverse(t, n), e)
    cols += [-_shift(part, j * m) for j in range(1, Q + 1)]
    if len(theta) > p + q + P + Q:
        cols.append(out(np.full(n, -full.sum())))
    return e, (np.column_stack(cols) if cols else np.empty((n, 0))), r


def _start(w, order, with_mean):
    """Start values: residuals of a long autoregression stand in for the shocks."""
    p, _, q, P, _, Q, m = order
    mean = w.mean() if with_mean else 0.0
    x = w - mean
    n = len(x)
    lags_w = list(range(1, p + 1)) + [m * i for i in range(1, P + 1)]
    lags_e = list(range(1, q + 1)) + [m * i for i in range(1, Q + 1)]
    coef = np.zeros(len(lags_w) + len(lags_e))
    k = min(max(10, 2 * max([*lags_w, *lags_e, 0])), n // 4)
    if coef.size and k > 0:
        e = np.zeros(n)
        if lags_e:
            long = np.column_stack([_shift(x, i) for i in range(1, k + 1)])[k:]
            e[k:] = x[k:] - long @ np.linalg.lstsq(long, x[k:], rcond=None)[0]
        cols = np.column_stack([_shift(x, i) for i in lags_w] + [_shift(e, j) for j in lags_e])
        skip = min(k + max([*lags_w, *lags_e]), n // 2)
        coef = np.linalg.lstsq(cols[skip:], x[skip:], rcond=None)[0]
    ar, sar = coef[:p], coef[p:p + P]
    ma, sma = coef[p + P:p + P + q], coef[p + P + q:]
    for _ in range(60):
        if _feasible(ar, ma, sar, sma):
            break
        ar, ma, sar, sma = [c * 0.9 ** np.arange(1, len(c) + 1) for c in (ar, ma, sar, sma)]
    return np.concatenate([ar, ma, sar, sma, [mean] if with_mean else []])


def _search(theta, residual, feasible, steps: int):
    """Damped Gauss-Newton for the least sum of squares: (parameters, sum, settled).
    ``residual(theta)`` gives values and Jacobian; a step out of the feasible
    region is refused. Not settled: the steps ran out first."""
    e, jac = residual(theta, True)
    sse, damping, settled = e @ e, 1e-3, len(theta) == 0
    for _ in range(steps):
        if settled:
            break
        h = jac.T @ jac
        move = np.linalg.lstsq(h + damping * np.diag(np.diag(h) + 1e-12), -jac.T @ e, rcond=None)[0]
        trial = theta + move
        ok = feasible(trial)
        new = residual(trial, False)[0] if ok else None
        if ok and np.isfinite(new @ new) and new @ new < sse:
            settled = sse - new @ new <= 1e-9 * sse
            theta = trial
            e, jac = residual(theta, True)
            sse, damping = e @ e, max(damping / 5, 1e-9)
        else:
            damping *= 5
            settled = damping > 1e8
    return theta, sse, settled


def _exact_residual(w, theta, order, jacobian):
    """Whitened values times the n-th root of the determinant's square root."""
    def values(t):
        ar, ma, mean = _full(t, order)
        z, logdet = whiten(w - mean, ar, ma)
        return z * np.exp(logdet / (2 * len(w)))

    z = values(theta)
    if not jacobian:
        return z, None
    cols = []
    for i in range(len(theta)):
        # Coefficients move towards zero, so that the second point stays feasible.
        step = -1e-6 if theta[i] > 0 else 1e-6
        moved = theta.copy()
        moved[i] += step
        cols.append((values(moved) - z) / step)
    return z, (np.column_stack(cols) if cols else np.empty((len(w), 0)))


def fit_series(y: np.ndarray, order, method: str = "css", steps: int = 500, compare_from: int = 0) -> dict:
    """Parameters of one series, by conditional sum of squares (``css``) or, from
    there on, by exact likelihood (``exact``).

    The conditional form leaves out the rows that an order needs to start; to
    compare orders, ``compare_from`` leaves the same first rows of the series
    out of all their likelihoods. A search that ``steps`` did not finish has the
    status ``unfinished``: it can be used, but no order search lets it win.
    """
    p, d, q, P, D, Q, m = order
    empty = {"status": "too_short", "n_obs": len(y)}
    if len(y) <= d + D * m:
        return empty
    w = _differenced(np.asarray(y, dtype=float), d, D, m)
    with_mean = d + D == 0
    k = p + q + P + Q + with_mean
    r = p + P * m
    if len(w) - r < max(k + 2, 3):
        return empty
    scale = w.std() or 1.0
    w = w / scale

    def feasible(t):
        return _feasible(*_unpack(t, p, q, P, Q)[:4])

    theta, sse, settled = _search(
        _start(w, order, with_mean), lambda t, jacobian: _residual(w, t, order, jacobian)[:2], feasible, steps
    )
    used = len(w) - r
    late = max(compare_from - d - D * m, r)
    if late >= len(w):
        return empty
    if method == "exact":
        theta, sse, settled = _search(theta, lambda t, jacobian: _exact_residual(w, t, order, jacobian), feasible, steps)
        used = len(w)
    # The concentrated likelihood; for the exact one the determinant is in the sum.
    shared, compared = sse, used
    if method != "exact" and late > r:
        e = _residual(w, theta, order)[0][late:]
        shared, compared = e @ e, len(e)
    loglik = -compared / 2 * (np.log(2 * np.pi * max(shared / compared * scale**2, 1e-300)) + 1)
    if method == "exact":
        full_ar, full_ma, mean = _full(theta, order)
        z, _ = whiten(w - mean, full_ar, full_ma)
        sse = z @ z
    sigma2 = sse / used * scale**2
    ar, ma, sar, sma, mean = _unpack(theta, p, q, P, Q)
    return {
        "mean": mean * scale, "ar": ar, "ma": ma, "sar": sar, "sma": sma, "sigma2": sigma2, "loglik": loglik,
        "aic": -2 * loglik + 2 * (k + 1), "bic": -2 * loglik + np.log(compared) * (k + 1), "n_obs": len(y),
        "status": "ok" if settled else "unfinished",
    }


# ---- use of fixed parameters ---------------------------------------------------------


class Model:
    """Lag polynomials of one parameter row."""

    def __init__(self, row):
        d, sd, m = int(row.d), int(row.sd), int(row.m)
        self.d, self.D, self.m = d, sd, m
        arma = np.convolve(_poly(row.ar, 1, -1), _poly(row.sar, max(m, 1), -1))
        self.arma = arma
        self.ma = np.convolve(_poly(row.ma, 1, 1), _poly(row.sma, max(m, 1), 1))
        full = arma
        for _ in range(d):
            full = np.convolve(full, [1, -1])
        for _ in range(sd):
            full = np.convolve(full, _poly([1.0], m, -1))
        self.full = full
        self.mean, self.sigma2 = row.mean, row.sigma2
        self.const = row.mean * arma.sum() if d + sd == 0 else 0.0

    @property
    def lost(self) -> int:
        """Rows at the start that have no one-step forecast."""
        return len(self.full) - 1

    def residuals(self, y: np.ndarray) -> np.ndarray:
        u = _apply(self.full, y) - self.const
        u[:self.lost] = 0
        return _filter(_inverse(self.ma, len(y)), u)

    def last_residuals(self, windows: np.ndarray) -> np.ndarray:
        """Last len(ma) - 1 residuals of each row, each row filtered on its own."""
        q, n = len(self.ma) - 1, windows.shape[1]
        u = np.zeros_like(windows)
        for i, c in enumerate(self.full):
            u[:, self.lost:] += c * windows[:, self.lost - i:n - i]
        u[:, self.lost:] -= self.const
        response = _inverse(self.ma, n)
        out = np.zeros((len(windows), q))
        for j in range(min(q, n)):
            out[:, q - 1 - j] = u[:, :n - j] @ response[:n - j][::-1]
        return out

    def ahead(self, tail: np.ndarray, shocks: np.ndarray, h: int) -> np.ndarray:
        """h forecasts per row from its last values and last residuals."""
        r, q = len(self.full) - 1, len(self.ma) - 1
        path = np.concatenate([tail[:, tail.shape[1] - r:], np.zeros((len(tail), h))], axis=1)
        for i in range(h):
            f = np.full(len(tail), self.const)
            for j in range(1, r + 1):
                f -= self.full[j] * path[:, r + i - j]
            for j in range(i + 1, q + 1):
                f += self.ma[j] * shocks[:, q + i - j]
            path[:, r + i] = f
        return path[:, r:]

    def spread(self, h: int) -> np.ndarray:
        """Standard errors of the h forecasts, from the psi weights."""
        psi = _times(_inverse(self.full, h), self.ma, h)
        return np.sqrt(self.sigma2 * np.cumsum(psi[:h] ** 2))

    def origins(self, y: np.ndarray, rows: np.ndarray, h: int, history: int | None) -> np.ndarray:
        """Forecasts from each origin row; ``history`` limits the rows it may see."""
        q, r = len(self.ma) - 1, self.lost
        if history is None:
            e = np.concatenate([np.zeros(q), self.residuals(y)])
            shocks = e[rows[:, None] + 1 + np.arange(q)] if q else np.zeros((len(rows), 0))
            tail = y[rows[:, None] - r + 1 + np.arange(r)] if r else np.zeros((len(rows), 0))
            return self.ahead(tail, shocks, h)
        out = np.zeros((len(rows), h))
        for length in np.unique(np.minimum(rows + 1, history)):
            at = np.flatnonzero(np.minimum(rows + 1, history) == length)
            windows = y[rows[at][:, None] - length + 1 + np.arange(length)]
            out[at] = self.ahead(windows, self.last_residuals(windows), h)
        return out


# ---- DataFrame operators -----------------------------------------------------------


def order_rows(orders: Sequence[Sequence[int]]) -> list[dict]:
    """(p, d, q) or (p, d, q, P, D, Q, m) tuples as numbered rows."""
    return [
        {"grid_id": i, **dict(zip(ORDER, [*o, *([0] * (7 - len(o)))]))} for i, o in enumerate(orders)
    ]


def order_grid(p=(1,), d=(0,), q=(1,), sp=(0,), sd=(0,), sq=(0,), m: int = 0) -> list[tuple]:
    return [
        (a, b, c, e, f, g, m if e + f + g else 0)
        for a in p for b in d for c in q for e in sp for f in sd for g in sq
    ]


def _with_orders(packed: DataFrame, orders, key: str) -> DataFrame:
    if isinstance(orders, DataFrame):
        have = [c for c in ORDER if c in orders.columns]
        side = orders.select(
            key, *have, *[F.lit(0).alias(c) for c in ORDER if c not in have],
            (F.col("grid_id") if "grid_id" in orders.columns else F.lit(0)).cast("int").alias("grid_id"),
        )
        return packed.join(side, key)
    fields = ", ".join(f"{c}: int" for c in ["grid_id", *ORDER])
    # one literal for the whole list: a plan of thousands of them takes minutes
    return packed.select("*", F.inline(F.from_json(F.lit(json.dumps(order_rows(orders))), f"array<struct<{fields}>>")))


def _model_row(key: str, name, grid_id: int, order, found: dict) -> pd.DataFrame:
    empty = {c: np.nan for c in ("mean", "sigma2", "loglik", "aic", "bic")} | {c: [] for c in ("ar", "ma", "sar", "sma")}
    row = {**empty, key: name, "grid_id": grid_id, **dict(zip(ORDER, order)), **found}
    return pd.DataFrame([row])[[key, *[f.split()[0] for f in MODEL_FIELDS.split(", ")]]]


def fit_arima(
    series: DataFrame, orders, key: str = "series", date: str = "date", value: str = "value", method: str = "css",
    compare_from: int = 0,
) -> DataFrame:
    """One parameter row per series and order.

    ``orders`` is a list of order tuples, each fitted to every series, or a
    DataFrame with the key and the columns p, d, q (sp, sd, sq, m). A constant is
    estimated only without differencing.
    """
    todo = _with_orders(pack(series, key, date, value), orders, key)

    def fit(row):
        order = tuple(int(getattr(row, c)) for c in ORDER)
        found = fit_series(np.asarray(row.values), order, method, compare_from=compare_from)
        return _model_row(key, getattr(row, key), row.grid_id, order, found)

    return map_rows(todo, f"{key_field(series, key)}, {MODEL_FIELDS}", fit, key, "grid_id")


def fit_ar(series: DataFrame, p: int = 1, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """AR(p) with a constant by least squares on its own lags, as model rows.

    The lag products are summed by Spark; one small linear system per series is
    all that is left. AR(1) is the slope and intercept of a regression and
    needs no Python.
    """
    w = W.partitionBy(key).orderBy(date)
    lags = [F.lag(value, i).over(w).alias(f"_x{i}") for i in range(1, p + 1)]
    rows = series.filter(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias("_y"), *lags)
    rows = rows.filter(F.col(f"_x{p}").isNotNull())
    none = F.array().cast("array<double>")
    if p == 1:
        one = rows.groupBy(key).agg(
            F.regr_slope("_y", "_x1").alias("b"), F.regr_intercept("_y", "_x1").alias("a"),
            F.regr_sxx("_y", "_x1").alias("sxx"), F.regr_syy("_y", "_x1").alias("syy"),
            F.count(F.lit(1)).alias("n"),
        )
        coef = one.select(
            key, "n", F.array("b").alias("ar"), F.try_divide(F.col("a"), 1 - F.col("b")).alias("mean"),
            (F.col("syy") - F.col("b") * F.col("b") * F.col("sxx")).alias("sse"),
        )
    else:
        x = [F.lit(1.0), *[F.col(f"_x{i}") for i in range(1, p + 1)]]
        sums = rows.groupBy(key).agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(x[i] * x[j]) for i in range(p + 1) for j in range(i, p + 1)]).alias("xx"),
            F.array(*[F.sum(c * F.col("_y")) for c in x]).alias("xy"),
            F.sum(F.col("_y") * F.col("_y")).alias("yy"),
        )

        @F.pandas_udf("ar array<double>, mean double, sse double")
        def solve(xx: pd.Series, xy: pd.Series, yy: pd.Series) -> pd.DataFrame:
            out = []
            for products, b, c in zip(xx, xy, yy):
                a = np.zeros((p + 1, p + 1))
                a[np.triu_indices(p + 1)] = products
                beta = np.linalg.lstsq(a + np.triu(a, 1).T, b, rcond=None)[0]
                out.append((beta[1:], beta[0] / (1 - beta[1:].sum()), c - beta @ b))
            return pd.DataFrame(out, columns=["ar", "mean", "sse"])

        coef = sums.select(key, "n", solve("xx", "xy", "yy").alias("_s")).select(key, "n", "_s.*")
    sigma2 = F.col("sse") / F.col("n")
    loglik = -F.col("n") / 2 * (F.ln(2 * F.pi() * sigma2) + 1)
    k = p + 2
    out = coef.withColumns({
        "grid_id": F.lit(0), "p": F.lit(p), **{c: F.lit(0) for c in ORDER[1:]},
        "ma": none, "sar": none, "sma": none, "sigma2": sigma2, "loglik": loglik,
        "n_obs": F.col("n") + p, "status": F.lit("ok"),
    }).withColumns({"aic": -2 * F.col("loglik") + 2 * k, "bic": -2 * F.col("loglik") + F.ln("n") * k})
    return out.select(key, *[f.split()[0] for f in MODEL_FIELDS.split(", ")])


_MODEL_COLUMNS = [*ORDER, "mean", "ar", "ma", "sar", "sma", "sigma2"]


def _with_model(packed: DataFrame, models: DataFrame, key: str) -> DataFrame:
    usable = models.filter(F.col("status") != "too_short") if "status" in models.columns else models
    return packed.join(usable.select(key, *_MODEL_COLUMNS), key, "left")


def _model_of(row) -> Model | None:
    return None if row.ar is None else Model(row)


def _no_forecast(row, key: str, schema: str) -> pd.DataFrame:
    """One row of nulls for a series without a usable model or with too few days."""
    names = [f.split()[0].strip("`") for f in schema.split(", ")]
    return pd.DataFrame([{n: getattr(row, key) if n == key else None for n in names}], columns=names)


def forecast(
    series: DataFrame, models: DataFrame, h: int = 7, origin=None, history: int | None = 150,
    key: str = "series", date: str = "date", value: str = "value", z: float = 1.959963984540054,
) -> DataFrame:
    """h-step forecast with mean and interval from the last row of each series.

    A series without a usable model, or with too few days for it, has one row of
    nulls, here and in ``fitted`` and ``backtest``.
    ``origin`` cuts the series at a date, that date included; the last
    ``history`` rows before it are what the fixed parameters are applied to.
    """
    seen = series.filter(F.col(value).isNotNull()).select(key, date, value)
    if origin is not None:
        seen = up_to(seen, origin, date)
    if history is not None:
        seen = last_n(seen, history, key, date)
    todo = _with_model(pack(seen, key, date, value), models, key)

    schema = (
        f"{key_field(series, key)}, forecast_date date, forecasted_date date, h int, forecast double, "
        "mean_ci_lower double, mean_ci_upper double"
    )

    def run(row):
        model, y = _model_of(row), np.asarray(row.values)
        if model is None or len(y) < max(model.lost, 1):
            return _no_forecast(row, key, schema)
        mean = model.origins(y, np.array([len(y) - 1]), h, None)[0]
        half = z * model.spread(h)
        steps = np.arange(1, h + 1)
        return pd.DataFrame({
            key: getattr(row, key), "forecast_date": to_dates(np.full(h, row.days[-1])),
            "forecasted_date": to_dates(row.days[-1] + steps), "h": steps,
            "forecast": mean, "mean_ci_lower": mean - half, "mean_ci_upper": mean + half,
        })

    return map_rows(todo, schema, run, key)


def fitted(series: DataFrame, models: DataFrame, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """One-step forecast of every row inside the sample, and its residual."""
    todo = _with_model(pack(series, key, date, value), models, key)

    schema = f"{key_field(series, key)}, date date, observed double, forecast double, residual double"

    def run(row):
        model, y = _model_of(row), np.asarray(row.values)
        if model is None or len(y) <= model.lost:
            return _no_forecast(row, key, schema)
        e = model.residuals(y)[model.lost:]
        y = y[model.lost:]
        return pd.DataFrame({
            key: getattr(row, key), "date": to_dates(row.days[model.lost:]), "observed": y, "forecast": y - e, "residual": e,
        })

    return map_rows(todo, schema, run, key)


def backtest(
    series: DataFrame, models: DataFrame, h: int = 7, first: int = 1, with_last: bool = True, history: int | None = None,
    key: str = "series", date: str = "date", value: str = "value",
) -> DataFrame:
    """Forecasts from every origin row of a series with fixed parameters.

    ``first`` is the number of rows the first origin has behind it, itself
    included (the train length). All origins of a series come from one pass: a
    residual depends on earlier days only, so it serves every later origin.
    With ``history`` each origin sees its last rows only and is filtered anew.
    """
    todo = _with_model(pack(series, key, date, value), models, key)

    schema = f"{key_field(series, key)}, origin date, h int, forecast double"

    def run(row):
        model, y, days = _model_of(row), np.asarray(row.values), np.asarray(row.days)
        if model is None:
            return _no_forecast(row, key, schema)
        rows = np.arange(max(first - 1, model.lost - 1, 0), len(y) - (0 if with_last else 1))
        if history is not None and history < model.lost or not len(rows):
            return _no_forecast(row, key, schema)
        paths = model.origins(y, rows, h, history)
        steps = np.tile(np.arange(1, h + 1), len(rows))
        return pd.DataFrame({
            key: getattr(row, key), "origin": to_dates(np.repeat(days[rows], h)), "h": steps, "forecast": paths.ravel(),
        })

    return map_rows(todo, schema, run, key)


def backfill(
    series: DataFrame, models: DataFrame, spine: DataFrame | None = None, h: int = 7, history: int = 150,
    key: str = "series", date: str = "date", value: str = "value",
) -> DataFrame:
    """What the daily forecast would have given on every past date of every series."""
    out = backtest(series, models, h, 1, True, history, key, date, value)
    if spine is None:
        return out
    return out.join(spine.select(F.col(spine.columns[0]).alias("origin")).distinct(), "origin", "left_semi")


def search_orders(
    series: DataFrame, grid: Sequence[Sequence[int]], key: str = "series", date: str = "date", value: str = "value",
    metric: str = "aic", method: str = "css",
) -> DataFrame:
    """Best order per series: all orders are fitted in parallel and compared on
    the same rows; ties go to the first in grid order."""
    full = [[*o, *([0] * (7 - len(o)))] for o in grid]
    start = max(d + sd * m + p + sp * m for p, d, _, sp, sd, _, m in full)
    fits = fit_arima(series, grid, key, date, value, method, start)
    return best(fits.withColumn(metric, F.when(F.col("status") != "unfinished", F.col(metric))), [key], metric)


def _stepwise(y: np.ndarray, d: int, D: int, m: int, limit: int, start, method: str, metric: str):
    """Best neighbour after best neighbour, from a few simple orders on."""
    tried: dict[tuple, dict] = {}

    def score(o) -> float:
        if o not in tried:
            p, q, P, Q = o
            tried[o] = fit_series(y, (p, d, q, P, D, Q, m if P + D + Q else 0), method)
        found = tried[o].get(metric) if tried[o]["status"] == "ok" else None
        return np.inf if found is None or not np.isfinite(found) else found

    seasonal = int(m > 0)
    first = [tuple(start) if seasonal else (*start[:2], 0, 0), (0, 0, 0, 0), (1, 0, seasonal, 0), (0, 1, 0, seasonal)]
    now = min(first, key=score)
    while True:
        moves = [(a, b, 0, 0) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (-1, -1))]
        moves += [(0, 0, a, b) for a, b, _, _ in moves] if seasonal else []
        near = [tuple(a + b for a, b in zip(now, move)) for move in moves]
        near = [o for o in near if all(0 <= v <= limit for v in o)]
        best_near = min(near, key=score)
        if score(best_near) >= score(now):
            p, q, P, Q = now
            return (p, d, q, P, D, Q, m if P + D + Q else 0), tried[now]
        now = best_near


def search_stepwise(
    series: DataFrame, d: int = 1, sd: int = 0, m: int = 0, limit: int = 7, start=(1, 1, 1, 1), metric: str = "aic",
    method: str = "exact", key: str = "series", date: str = "date", value: str = "value",
) -> DataFrame:
    """Order search (p, q, seasonal p, q up to ``limit``) that walks from order
    to order while the criterion improves; one series is one task's work."""
    def run(row):
        order, found = _stepwise(np.asarray(row.values), d, sd, m, limit, start, method, metric)
        return _model_row(key, getattr(row, key), 0, order, found)

    return map_rows(pack(series, key, date, value), f"{key_field(series, key)}, {MODEL_FIELDS}", run, key)
