"""Unit-root test from one triangle of summed products per series.

The regression of a change on the level before it, on lagged changes and a
constant needs only sums of products of these columns. All lag counts are
leading parts of one triangle, so one elimination fits them all. Everything is
a column expression over packed series (one row per series, its days an array).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import task_count
from .stats import normal_tail

# Published response surface for the unit-root p-value, one
# variable with a constant (MacKinnon 1994).
ADF_MIN, ADF_MAX, ADF_STAR = -18.83, 2.74, -1.61
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)

#: A column that the ones before it explain up to this share is left out.
COLLINEAR = 1e-12
#: Changes explained up to this share are explained exactly: no statistic.
EXACT = 1e-13


def adf_p(stat: Column) -> Column:
    """p of the statistic, from the published surface."""
    small = sum(c * F.pow(stat, F.lit(i)) for i, c in enumerate(ADF_SMALL))
    large = sum(c * F.pow(stat, F.lit(i)) for i, c in enumerate(ADF_LARGE))
    p = normal_tail(-F.when(stat <= ADF_STAR, small).otherwise(large))
    return F.when(stat > ADF_MAX, F.lit(1.0)).when(stat < ADF_MIN, F.lit(0.0)).otherwise(p)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x * y))


def _up_to(n: Column, first: int = 1) -> Column:
    """``first`` .. ``n``; empty where ``n`` is one less than ``first``."""
    return F.slice(F.sequence(F.lit(first - 1), n), F.lit(2), n - first + 1)


def _changes(u: Column) -> Column:
    n = F.size(u)
    return F.zip_with(F.slice(u, F.lit(2), n - 1), F.slice(u, F.lit(1), n - 1), lambda b, a: b - a)


def _lag_sums(dy: Column, lags: Column) -> Column:
    """Sums of dy[t] dy[t-h] over t > lags, h = 0 .. lags: the only sums of products over all days."""
    m = F.size(dy) - lags
    return F.transform(F.sequence(F.lit(0), lags), lambda h: _dot(F.slice(dy, lags + 1, m), F.slice(dy, lags + 1 - h, m)))


def _moved(start: Column, steps: Column, change: Callable[[Column, Column], Column]) -> Column:
    """``start`` and what it comes to after each of ``steps``; ``change`` sees the step and the last value."""
    return F.aggregate(steps, F.array(start), lambda out, i: F.concat(out, F.array(change(i, F.element_at(out, -1)))))


def _triangle(u: Column, dy: Column, sums: Column, most: Column, lags: Column) -> Column:
    """Upper triangle of the products of: constant, changes 1 .. lags days back, level, change; over days t > lags.

    ``sums`` are those of ``_lag_sums`` over t > most; the days between are
    added. The window of a pair of lags moves by one day to that of the next,
    so each further sum gains one product and loses one.
    """
    n, s = F.size(dy), lags + 1
    at = lambda i: F.element_at(dy, i)
    between = _up_to(most, s)
    first = F.transform(
        F.sequence(F.lit(0), lags),
        lambda h: F.element_at(sums, h + 1) + F.aggregate(between, F.lit(0.0), lambda x, t: x + at(t) * at(t - h)),
    )
    level = F.slice(u, s, n - lags)

    def build(top):
        products = _moved(top, _up_to(lags), lambda i, above: F.transform(
            F.sequence(i, lags), lambda j: F.element_at(above, j - i + 1) + at(s - i) * at(s - j) - at(n + 1 - i) * at(n + 1 - j)
        ))
        total = _moved(_total(F.slice(dy, s, n - lags)), _up_to(lags), lambda i, x: x + at(s - i) - at(n + 1 - i))
        # the level of a day is that of the day before and its change
        with_level = _moved(_dot(level, F.slice(dy, s, n - lags)), _up_to(lags), lambda i, x: (
            x + F.element_at(top, i) + F.element_at(u, s) * at(s - i) - F.element_at(u, n + 1) * at(n + 1 - i)
        ))
        return _let(F.struct(products.alias("p"), total.alias("s"), with_level.alias("l")), lambda x: join(top, x["p"], x["s"], x["l"]))

    def join(top, products, total, with_level):
        constant = F.concat(
            F.array((n - lags).cast("double")), F.slice(total, F.lit(2), lags), F.array(_total(level), F.element_at(total, 1))
        )
        lagged = F.transform(
            _up_to(lags),
            lambda i: F.concat(F.element_at(products, i + 1), F.array(F.element_at(with_level, i + 1), F.element_at(top, i + 1))),
        )
        last = F.array(F.array(_dot(level, level), F.element_at(with_level, 1)), F.array(F.element_at(top, 1)))
        return F.concat(F.array(constant), lagged, last)

    return _let(first, build)


def _to_unit(rows: Column) -> Column:
    """The triangle with a diagonal of ones; columns of zeros stay zeros."""
    scale = F.transform(rows, lambda r: F.when(F.element_at(r, 1) > 0, 1 / F.sqrt(F.element_at(r, 1))).otherwise(F.lit(0.0)))
    return _let(scale, lambda z: F.transform(
        rows, lambda r, i: F.zip_with(r, F.slice(z, i + 1, F.size(r)), lambda x, other: x * other * F.element_at(z, i + 1))
    ))


def _eliminate(rows: Column, lags: Column) -> Column:
    """What is left of level and change for 0 .. lags lagged changes: (ll, ly, yy)."""

    def without(rows, pivot):
        rest = F.slice(rows, F.lit(2), F.size(rows) - 1)
        w = F.element_at(pivot, 1)
        taken = F.transform(
            rest,
            lambda r, i: F.zip_with(r, F.slice(pivot, i + 2, F.size(r)), lambda x, y: x - F.element_at(pivot, i + 2) / w * y),
        )
        return F.when(w > COLLINEAR, taken).otherwise(rest)

    def step(acc, _):
        rows = _let(F.element_at(acc["rows"], 1), lambda pivot: without(acc["rows"], pivot))

        def put(rows):
            level = F.element_at(rows, -2)
            left = F.struct(
                F.element_at(level, 1).alias("ll"), F.element_at(level, 2).alias("ly"),
                F.element_at(F.element_at(rows, -1), 1).alias("yy"),
            )
            return F.struct(rows.alias("rows"), F.concat(acc["out"], F.array(left)).alias("out"))

        return _let(rows, put)

    none = F.array().cast("array<struct<ll: double, ly: double, yy: double>>")
    return F.aggregate(F.sequence(F.lit(0), lags), F.struct(rows.alias("rows"), none.alias("out")), step, lambda acc: acc["out"])


def _fits(lags: Column) -> Column:
    triangle = _triangle(F.col("_u"), F.col("_dy"), F.col("_sums"), F.col("_most"), lags)
    return _let(triangle, lambda t: _let(_to_unit(t), lambda rows: _eliminate(rows, lags)))


def _unexplained(x: Column) -> Column:
    """Share of the changes' squares left after the level as well."""
    return x["yy"] - F.when(x["ll"] > COLLINEAR, x["ly"] * x["ly"] / x["ll"]).otherwise(F.lit(0.0))


def adf(
    df: DataFrame, d: Sequence[int] = (0, 1, 2, 3), key: str = "series", date: str = "date", value: str = "value",
    max_lag: int | None = None,
) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant at each order of differencing.

    All lag counts are compared by AIC on the same days; the chosen one is
    fitted again on all days that it can use. Null days are left out. A
    statistic is null for a constant series, one of fewer than six days, and
    one whose changes the regression explains exactly.
    """
    spread = df.select(key, date, value).filter(F.col(value).isNotNull()).repartition(task_count(df.sparkSession), key)
    days = F.array_sort(F.collect_list(F.struct(F.col(date).alias("d"), F.col(value).cast("double").alias("v"))))
    packed = spread.groupBy(key).agg(F.transform(days, lambda x: x["v"]).alias("_v"))
    orders = []
    for order in d:
        u = F.col("_v")
        for _ in range(order):
            u = F.when(F.size(u) > 1, _let(u, _changes)).otherwise(F.array().cast("array<double>"))
        orders.append(F.struct(F.lit(order).alias("d"), u.alias("u")))
    rows = packed.select(key, F.explode(F.array(*orders)).alias("_o")).select(key, "_o.d", "_o.u")
    n = F.size("u")
    room = F.floor(n / 2).cast("int") - 2
    most = F.least(F.ceil(12 * F.pow(n / 100, F.lit(0.25))).cast("int"), room) if max_lag is None else F.lit(max_lag)
    usable = (n >= 6) & (most >= 0) & (F.array_max("u") > F.array_min("u"))
    middle = _let(F.floor(_total(F.col("u")) / n).cast("double"), lambda c: F.transform("u", lambda x: x - c))
    rows = rows.select(
        key, "d", n.alias("_n"), F.when(usable & (n - 1 > most), most).alias("_most"),
        F.when(usable, middle).alias("_u"), F.when(usable, _let(F.col("u"), _changes)).alias("_dy"),
    )
    rows = rows.withColumn("_sums", F.when(F.col("_most").isNotNull(), _lag_sums(F.col("_dy"), F.col("_most"))))
    m = F.col("_n") - 1 - F.col("_most")
    aic = F.transform(_fits(F.col("_most")), lambda x, k: m * F.ln(F.greatest(_unexplained(x), F.lit(1e-300))) + 2 * k)
    best = _let(aic, lambda a: F.array_position(a, F.array_min(a)).cast("int") - 1)
    rows = rows.withColumn("_lags", F.when(F.col("_most").isNotNull(), best))
    rows = rows.withColumn("_x", F.when(F.col("_lags").isNotNull(), F.element_at(_fits(F.col("_lags")), -1)))
    used = F.col("_n") - 1 - F.col("_lags")
    free = used - F.col("_lags") - 2
    x = F.col("_x")
    left = _unexplained(x)
    good = (free > 0) & (x["ll"] > COLLINEAR) & (left > EXACT)
    stat = F.when(good, x["ly"] / F.sqrt(left / free * x["ll"]))
    out = rows.select(
        key, "d", stat.alias("statistic"), F.when(free > 0, F.col("_lags")).cast("long").alias("lags"),
        F.when(free > 0, used).cast("long").alias("n_used"),
    )
    return out.select(key, "d", "statistic", adf_p(F.col("statistic")).alias("p"), "lags", "n_used")
