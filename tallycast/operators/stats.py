"""Series statistics. SQL aggregates and windows where they can express the
test; a grouped map with numpy for the rest, one series (days) per group."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import task_count
from .windows import slices

Z95 = 1.959963984540054  # Fixed value: 97.5 % point of the normal distribution.


@F.pandas_udf(T.DoubleType())
def normal_tail(z: pd.Series) -> pd.Series:
    """P(Z > z); used on one row per series."""
    return z.map(lambda v: 0.5 * math.erfc(v / math.sqrt(2.0)), na_action="ignore")


def _rank_sum_exact(u: float, a: int, b: int) -> float:
    """P(U >= u) for samples of a and b values without ties: the coefficients
    of the Gaussian binomial count the orders with each value of U."""
    small, large = sorted((a, b))
    ways = [1] + [0] * (small * large)
    for i in range(1, small + 1):
        for k in range(len(ways) - 1, large + i - 1, -1):
            ways[k] -= ways[k - large - i]
        for k in range(i, len(ways)):
            ways[k] += ways[k - i]
    return sum(ways[math.ceil(u):]) / sum(ways)


@F.pandas_udf(T.DoubleType())
def rank_sum_tail(u: pd.Series, a: pd.Series, b: pd.Series, ties: pd.Series, z: pd.Series) -> pd.Series:
    """Upper tail of the larger U: exact when a sample has at most eight values
    and nothing is tied, else normal. One row per series."""
    def tail(u, a, b, ties, z):
        if 0 < min(a, b) <= 8 and ties == 0:
            return _rank_sum_exact(max(u, a * b - u), int(a), int(b))
        return 0.5 * math.erfc(z / math.sqrt(2)) if z == z and z is not None else None

    return pd.Series([tail(*row) for row in zip(u, a, b, ties, z)], dtype="float64")


def chi2_tail(x: Column, df: int) -> Column:
    """P(chi-square with ``df`` degrees > x), by the recursion over df - 2."""
    if df % 2 == 0:
        tail, term, start = F.exp(-x / 2), F.exp(-x / 2), 2
    else:
        tail = 2 * normal_tail(F.sqrt(x))
        term, start = F.sqrt(2 * x / math.pi) * F.exp(-x / 2), 1
        if df > 1:
            tail, start = tail + term, 3
    for k in range(start + 2, df + 1, 2):
        term = term * x / (k - 2)
        tail = tail + term
    return tail


def bartlett(
    df: DataFrame, cuts: Sequence[int] = (62, 124), key: str = "series", date: str = "date", value: str = "value"
) -> DataFrame:
    """Equal variance over the slices of each series: statistic and p."""
    k = len(cuts) + 1
    part = slices(df.filter(F.col(value).isNotNull()), cuts, key, date)
    sums = []
    for i in range(k):
        x = F.when(F.col("slice") == i, F.col(value))
        sums += [F.count(x).alias(f"n{i}"), F.var_samp(x).alias(f"v{i}")]
    one = part.groupBy(key).agg(*sums)
    n = [F.col(f"n{i}") for i in range(k)]
    v = [F.col(f"v{i}") for i in range(k)]
    rest = sum(n[1:], n[0]) - k
    pooled = F.try_divide(sum([(n[i] - 1) * v[i] for i in range(1, k)], (n[0] - 1) * v[0]), rest)
    spread = rest * F.ln(pooled) - sum([(n[i] - 1) * F.ln(v[i]) for i in range(1, k)], (n[0] - 1) * F.ln(v[0]))
    inverse = sum([F.try_divide(F.lit(1.0), n[i] - 1) for i in range(1, k)], F.try_divide(F.lit(1.0), n[0] - 1))
    scale = 1 + (inverse - F.try_divide(F.lit(1.0), rest)) / (3 * (k - 1))
    enough = F.least(*n) > 1
    return one.select(key, F.when(enough, spread / scale).alias("statistic")).withColumn(
        "p", chi2_tail(F.col("statistic"), k - 1)
    )


def mann_whitney(
    df: DataFrame, cut: int = 98, key: str = "series", date: str = "date", value: str = "value"
) -> DataFrame:
    """Rank-sum test of the first ``cut`` rows against the rest, two-sided.

    Counted on distinct values: a value ranks after all smaller ones and half
    way through its own ties, so ranks need no row-level sort. p is exact for a
    sample of at most eight values without ties, else normal with tie and
    continuity correction.
    """
    part = slices(df.filter(F.col(value).isNotNull()), [cut], key, date)
    values = part.groupBy(key, value).agg(
        F.count_if(F.col("slice") == 0).alias("a"), F.count_if(F.col("slice") == 1).alias("b")
    )
    below = W.partitionBy(key).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    values = values.withColumn("b_below", F.coalesce(F.sum("b").over(below), F.lit(0)))
    t = (F.col("a") + F.col("b")).cast("double")
    sums = values.groupBy(key).agg(
        F.sum(F.col("a") * (F.col("b_below") + F.col("b") / 2)).alias("u"),
        F.sum("a").cast("double").alias("na"), F.sum("b").cast("double").alias("nb"),
        F.sum(t * t * t - t).alias("ties"),
    )
    n = F.col("na") + F.col("nb")
    pairs = F.col("na") * F.col("nb")
    sd = F.sqrt(pairs / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(F.abs(F.col("u") - pairs / 2) - 0.5, sd)
    sums = sums.withColumn("z", z)
    sums = sums.withColumn("_tail", rank_sum_tail("u", "na", "nb", "ties", "z"))
    p = F.when(F.col("_tail").isNotNull(), F.least(F.lit(1.0), 2 * F.col("_tail")))
    return sums.select(key, F.col("u").alias("statistic"), "z", p.alias("p"))


def _merges(rank: np.ndarray):
    """The levels of a merge sort from halves of one value up: (left places in
    order of rank, right places, first and end of the left ones that outrank
    each right one). All left values of a pair of halves are one run."""
    n = len(rank)
    at, width = np.arange(n), 1
    while width < n:
        half = at // width
        pair, right = half >> 1, half & 1 == 1
        keys = pair * n + rank
        left = at[~right][np.argsort(keys[~right], kind="stable")]
        run = keys[left]
        yield left, at[right], np.searchsorted(run, keys[right], "right"), np.searchsorted(run, (pair[right] + 1) * n)
        width *= 2


def _falls(rank: np.ndarray) -> int:
    """Pairs i < j with rank[i] > rank[j], by sorted runs, in memory of n."""
    return sum(int((end - first).sum()) for _, _, first, end in _merges(rank))


def _slope_median(x: np.ndarray, room: int = 2_000_000, draws: int = 4_000_000, seed: int = 5) -> float:
    """Exact median of (x[j] - x[i]) / (j - i) over i < j, up to rounding.

    A slope is at most s where x - s t falls or stays from i to j, so slopes up
    to s are counted as falls. Random pairs bracket the middle ranks, counts
    confirm the bracket, and once at most ``room`` slopes lie inside they are
    listed: the pairs whose order differs at its two ends. A bracket that holds
    too few of the drawn pairs is halved; one without width is the answer.
    """
    n = len(x)
    total = n * (n - 1) // 2
    if total <= room:
        return float(np.median(np.concatenate([(x[i + 1:] - x[i]) / np.arange(1, n - i) for i in range(n - 1)])))
    t = np.arange(n, dtype=float)
    r = np.random.default_rng(seed)
    scale = max(float(np.ptp(x)), 1e-300)
    x = x - x[0]

    def order(s: float) -> np.ndarray:
        return np.lexsort((-t, x - s * t))

    def rank(places: np.ndarray) -> np.ndarray:
        out = np.empty(n, dtype=np.int64)
        out[places] = np.arange(n)
        return out

    def up_to(s: float) -> int:
        return _falls(rank(order(s)))

    low, high = (total - 1) // 2, total // 2
    lo, hi, under, upto = -2 * scale, 2 * scale, 0, total
    while upto - under > room and hi - lo > 1e-13 * scale:
        i, j = r.integers(0, n, draws), r.integers(0, n, draws)
        i, j = i[i != j], j[i != j]
        s = (x[j] - x[i]) / (t[j] - t[i])
        s = np.sort(s[(s > lo) & (s <= hi)])
        middle = (lo + hi) / 2
        cuts = [middle]
        if len(s) >= 1000:
            share, margin = (low - under) / (upto - under) * len(s), 3 * math.sqrt(len(s))
            cuts = [float(s[max(0, int(share - margin))]), float(s[min(len(s) - 1, int(share + margin))])]
            # an end that stands for many equal slopes goes just below or above them
            cuts = [cuts[0] - 1e-14 * scale, cuts[1] + 1e-14 * scale]
            if cuts[0] <= lo and cuts[1] >= hi:
                cuts = [middle]
        for cut in cuts:
            if lo < cut < hi:
                count = up_to(cut)
                if count <= low:
                    lo, under = cut, count
                elif count > high:
                    hi, upto = cut, count
                else:  # the two middle slopes lie on both sides
                    return _between(x, t, cut)
    if upto - under > room:
        return (lo + hi) / 2
    first = order(lo)
    found = []
    for left, right, start, end in _merges(rank(order(hi))[first]):
        many = end - start
        runs = np.repeat(start - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        i, j = first[left[runs]], first[np.repeat(right, many)]
        found.append((x[j] - x[i]) / (t[j] - t[i]))
    inside = np.partition(np.concatenate(found), [low - under, high - under])
    return float(inside[low - under] + inside[high - under]) / 2


def _between(x: np.ndarray, t: np.ndarray, cut: float) -> float:
    """Mean of the largest slope up to ``cut`` and the smallest above it: both
    are slopes of places next to each other in the order of x - cut t."""
    y = x - cut * t
    places = np.lexsort((-t, y))
    i, j = places[:-1], places[1:]
    s = (x[j] - x[i]) / (t[j] - t[i])
    return float(s[s <= cut].max() + s[s > cut].min()) / 2


def _mann_kendall_of(key: str, date: str, value: str, alpha: float):
    columns = [key, "n", "s", "tau", "var_s", "z", "p", "trend", "slope", "intercept"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(date, kind="stable")[value].dropna().to_numpy(dtype=float)
        n = len(x)
        if n < 2:
            return pd.DataFrame({key: [pdf[key].iloc[0]], "n": [n]}).reindex(columns=columns)
        _, dense, ties = np.unique(x, return_inverse=True, return_counts=True)
        s = n * (n - 1) // 2 - int((ties * (ties - 1) // 2).sum()) - 2 * _falls(dense)
        ties = ties.astype(float)
        var = (n * (n - 1) * (2 * n + 5) - (ties * (ties - 1) * (2 * ties + 5)).sum()) / 18
        z = 0.0 if s == 0 or var == 0 else (s - np.sign(s)) / math.sqrt(var)
        p = math.erfc(abs(z) / math.sqrt(2))
        slope = _slope_median(x)
        trend = "no trend" if p >= alpha else ("increasing" if z > 0 else "decreasing")
        row = [pdf[key].iloc[0], n, s, s / (0.5 * n * (n - 1)), var, z, p, trend, slope,
               float(np.median(x) - (n - 1) / 2 * slope)]
        return pd.DataFrame([row], columns=columns)

    return run


def mann_kendall(
    df: DataFrame, key: str = "series", date: str = "date", value: str = "value", alpha: float = 0.05
) -> DataFrame:
    """Monotone trend test with tie correction, median slope and intercept.

    Falls are counted by merging, the median slope is selected between counts:
    n log n for a series of n days, pairs never become rows.
    """
    kt = dict(df.dtypes)[key]
    schema = f"`{key}` {kt}, n long, s long, tau double, var_s double, z double, p double, trend string, slope double, intercept double"
    spread = df.select(key, date, value).repartition(task_count(df.sparkSession), key)
    return spread.groupBy(key).applyInPandas(_mann_kendall_of(key, date, value, alpha), schema)


def acf(
    df: DataFrame, k: int = 30, key: str = "series", date: str = "date", value: str = "value"
) -> DataFrame:
    """Autocorrelation for lags 0 .. k with the half width of its 95 % bound.

    One shuffle: the mean and all lagged values are windows over the same
    partitioning, the products are summed in place. Lags beyond the length of a
    series are left out.
    """
    wide = acf_array(df, k, key, date, value)
    lags = wide.select(key, "n", "r", F.explode(F.sequence(F.lit(0), F.least(F.lit(k), F.col("n").cast("int") - 1))).alias("lag"))
    squares = F.aggregate(
        F.slice("r", 2, F.greatest(F.col("lag") - 1, F.lit(0))), F.lit(0.0), lambda s, x: s + x * x
    )
    bound = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(Z95 * F.sqrt((1 + 2 * squares) / F.col("n")))
    return lags.select(key, "lag", F.try_element_at("r", F.col("lag") + 1).alias("r"), bound.alias("bound"))


def acf_array(df: DataFrame, k: int, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """Length and autocorrelations ``r`` for lags 0 .. k, one row per series."""
    w = W.partitionBy(key).orderBy(date)
    dev = df.filter(F.col(value).isNotNull()).select(
        key, date, (F.col(value) - F.avg(value).over(W.partitionBy(key))).alias("_d")
    )
    dev = dev.withColumns({f"_l{h}": F.lag("_d", h).over(w) for h in range(1, k + 1)})
    sums = [F.sum(F.col("_d") * F.col("_d")).alias("_c0")]
    sums += [F.sum(F.col("_d") * F.col(f"_l{h}")).alias(f"_c{h}") for h in range(1, k + 1)]
    one = dev.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *sums)
    r = F.array(*[F.try_divide(F.col(f"_c{h}"), F.col("_c0")) for h in range(k + 1)])
    return one.select(key, "n", r.alias("r"))


def pacf(
    df: DataFrame, k: int = 30, key: str = "series", date: str = "date", value: str = "value"
) -> DataFrame:
    """Partial autocorrelation for lags 0 .. k by the Durbin-Levinson recursion.

    The recursion is a fold over the lags on the array of autocorrelations of
    a series: one row per series, no Python.
    """
    wide = acf_array(df, k, key, date, value)

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def step(acc, i):
        phi = acc["phi"]
        past = F.slice("r", F.lit(2), i - 1)
        num = F.element_at("r", i + 1) - dot(phi, F.reverse(past))
        last = F.try_divide(num, 1 - dot(phi, past))
        new = F.concat(F.zip_with(phi, F.reverse(phi), lambda a, b: a - last * b), F.array(last))
        return F.struct(new.alias("phi"), F.concat(acc["out"], F.array(last)).alias("out"))

    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.array(F.lit(1.0)).alias("out"))
    steps = F.slice(F.sequence(F.lit(1), F.lit(k)), F.lit(1), F.least(F.lit(k), F.col("n").cast("int") - 1))
    out = F.aggregate(steps, start, step, lambda acc: acc["out"])
    rows = wide.select(key, "n", F.posexplode(out).alias("lag", "pacf"))
    bound = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(Z95 / F.sqrt(F.col("n")))
    return rows.select(key, "lag", "pacf", bound.alias("bound"))


def _periodogram_of(key: str, date: str, value: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(date, kind="stable")[value].dropna().to_numpy(dtype=float)
        n = len(y)
        norm = math.sqrt(float((y * y).sum()))
        amplitude = np.abs(np.fft.rfft(y / norm if norm else y))[1:]
        k = np.arange(1, len(amplitude) + 1)
        return pd.DataFrame({key: pdf[key].iloc[0], "k": k, "period": n / k, "amplitude": amplitude})

    return run


def periodogram(df: DataFrame, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """Amplitude by period of the series scaled to length one."""
    schema = f"`{key}` {dict(df.dtypes)[key]}, k long, period double, amplitude double"
    spread = df.select(key, date, value).repartition(task_count(df.sparkSession), key)
    return spread.groupBy(key).applyInPandas(_periodogram_of(key, date, value), schema)
