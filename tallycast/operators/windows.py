"""Window operators over one row per (key, date); see the series contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import day_number


def _by_date(key: str, date: str):
    return W.partitionBy(key).orderBy(date)


def with_daily_change(
    df: DataFrame, key: str = "Country_Region", cols: Sequence[str] = ("Confirmed", "Deaths", "Recovered"),
    date: str = "date", fill: float | None = 0.0, prefix: str = "New_",
) -> DataFrame:
    """Change against the row before, on the raw values.

    The first row and both sides of a null have no change; they get ``fill``
    (``None`` keeps the null). With a fill the measures are filled too, after
    the change is taken.
    """
    w = _by_date(key, date)
    change = {f"{prefix}{c}": F.col(c) - F.lag(c).over(w) for c in cols}
    df = df.withColumns(change)
    if fill is None:
        return df
    return df.withColumns({c: F.coalesce(c, F.lit(fill)) for c in [*change, *cols]})


def difference(df: DataFrame, d: int = 1, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """``d`` times differenced value as ``diff``; rows without one are dropped."""
    w = _by_date(key, date)
    df = df.withColumn("diff", F.col(value))
    for _ in range(d):
        df = df.withColumn("diff", F.col("diff") - F.lag("diff").over(w))
    return df.filter(F.col("diff").isNotNull())


def _full_mean(value: str, w, n: int) -> Column:
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def trailing_mean(df: DataFrame, n: int = 7, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """Mean of this row and the n - 1 before; null until n rows exist."""
    w = _by_date(key, date).rowsBetween(-(n - 1), 0)
    return df.withColumn("trailing_mean", _full_mean(value, w, n))


def forward_mean(df: DataFrame, n: int = 7, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """Mean of the next n rows; null where fewer follow."""
    w = _by_date(key, date).rowsBetween(1, n)
    return df.withColumn("forward_mean", _full_mean(value, w, n))


def repair_outliers(
    df: DataFrame, threshold: float | Column, key: str = "series", date: str = "date", value: str = "value", days: int = 7
) -> DataFrame:
    """A value above the threshold becomes the mean of the calendar days before it.

    ``threshold`` may be a column (null: no repair), so each series can have its
    own. A value with no day before it in the frame stays.
    """
    limit = F.lit(threshold) if isinstance(threshold, (int, float)) else threshold
    w = W.partitionBy(key).orderBy(day_number(date)).rangeBetween(-days, -1)
    hit = F.coalesce(F.col(value) > limit, F.lit(False))
    before = F.avg(value).over(w)
    df = df.withColumn("repaired", hit & before.isNotNull())
    return df.withColumn(value, F.when(F.col("repaired"), before).otherwise(F.col(value)))


def repair_zeros(df: DataFrame, key: str = "series", date: str = "date", value: str = "value", days: int = 7) -> DataFrame:
    """Zeros become the mean of the calendar days before, earlier repairs included.

    Each repair feeds the next one, which no window frame can express. So the
    days and values of a series (bounded by the calendar) are folded in date
    order, with the last ``days`` known days as a ring; only repairs are handed
    on and joined to the rows, other columns are not packed. ``zero_status`` is
    kept, repaired or left (fewer than ``days`` days known right before it, or a
    day among them twice). A zero without a date is left.
    """
    known = df.filter(F.col(date).isNotNull() & F.col(value).isNotNull())
    packed = known.groupBy(F.col(key).alias("_repair_key")).agg(
        F.array_sort(F.collect_list(F.struct(F.unix_date(date).alias("d"), F.col(value).cast("double").alias("v")))).alias("_p")
    )
    empty = F.array().cast("array<struct<d:int,v:double>>")

    def step(acc: Column, e: Column) -> Column:
        ring = acc["ring"]
        hit = (e["v"] == 0) & (F.size(ring) == days) & (F.get(ring, F.lit(0))["d"] == e["d"] - days)
        mean = F.aggregate(ring, F.lit(0.0), lambda total, x: total + x["v"]) / days
        now = F.array(F.struct(e["d"].alias("d"), F.when(hit, mean).otherwise(e["v"]).alias("v")))
        last = F.when(F.size(ring) == days, F.slice(ring, 2, days - 1)).otherwise(ring)
        return F.struct(F.concat(last, now).alias("ring"), F.when(hit, F.concat(acc["fixed"], now)).otherwise(acc["fixed"]).alias("fixed"))

    fixed = F.aggregate("_p", F.struct(empty.alias("ring"), empty.alias("fixed")), step)["fixed"]
    repairs = packed.filter(F.exists("_p", lambda e: e["v"] == 0)).select("_repair_key", F.inline(fixed)).withColumnsRenamed({"d": "_repair_day", "v": "_repair"}).dropDuplicates(["_repair_key", "_repair_day"])
    joined = df.join(repairs, F.col(key).eqNullSafe(F.col("_repair_key")) & (F.unix_date(date) == F.col("_repair_day")) & (F.col(value) == 0), "left")
    status = F.when(F.coalesce(F.col(value) != 0, F.lit(True)), "kept").when(F.col("_repair").isNotNull(), "repaired").otherwise("left")
    repaired = F.coalesce(F.col("_repair").cast(df.schema[value].dataType), F.col(value))
    return joined.select(*[repaired.alias(c) if c == value else F.col(c) for c in df.columns], status.alias("zero_status"))


def last_n(df: DataFrame, n: int = 150, key: str = "series", date: str = "date") -> DataFrame:
    """Last n rows per series. The filter on row_number is pushed below the
    shuffle as a group limit, so a map task sends at most n rows per key."""
    w = W.partitionBy(key).orderBy(F.col(date).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def head_n(df: DataFrame, n: int = 30, key: str = "series", date: str = "date") -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(_by_date(key, date))).filter(F.col("_rn") <= n).drop("_rn")


def tail_n(df: DataFrame, n: int = 30, key: str = "series", date: str = "date") -> DataFrame:
    return last_n(df, n, key, date)


def split(
    df: DataFrame, n: int | Column | None = None, share: float | None = None, key: str = "series", date: str = "date"
) -> DataFrame:
    """``part`` = train for the first n rows (or the share of rows) of a series, else test."""
    row = F.row_number().over(_by_date(key, date))
    if share is not None:
        limit = F.rint(F.count(F.lit(1)).over(W.partitionBy(key)) * F.lit(share))
    else:
        limit = F.lit(n) if isinstance(n, int) else n
    return df.withColumn("part", F.when(row <= limit, F.lit("train")).otherwise(F.lit("test")))


def slices(df: DataFrame, cuts: Sequence[int], key: str = "series", date: str = "date") -> DataFrame:
    """``slice`` 0, 1, .. by row number: rows up to each cut, then the rest."""
    df = df.withColumn("_rn", F.row_number().over(_by_date(key, date)))
    which = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        which = F.when(F.col("_rn") <= cuts[i], F.lit(i)).otherwise(which)
    return df.withColumn("slice", which).drop("_rn")


def lag_matrix(df: DataFrame, n: int = 7, key: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """n past values as features x1 (oldest) .. xn and the value as target y."""
    w = _by_date(key, date)
    df = df.select(
        key, date, *[F.lag(value, n - i).over(w).alias(f"x{i + 1}") for i in range(n)],
        F.col(value).alias("y"), F.row_number().over(w).alias("_rn"),
    )
    return df.filter(F.col("_rn") > n).drop("_rn")
