"""Equi joins. No side is hinted to be broadcast unless its size is fixed;
for all others Catalyst and adaptive execution decide from measured sizes and
split skewed partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import day_number


def join_tweet_user(tweets: DataFrame, users: DataFrame) -> DataFrame:
    """Tweets with the location of their author; exact duplicates once.

    Users come again on every page, so they are made distinct before the join:
    a tweet meets each location of its author once, and the texts are shuffled
    for the join and the final step only.
    """
    u = users.distinct()
    return (
        tweets.join(u, tweets.author_id == u.id, "inner")
        .select("created_at", "text", "location")
        .dropDuplicates()
    )


def lookup(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], cols: Sequence[str], how: str = "left") -> DataFrame:
    """Columns of a dimension added to a fact; ``on`` maps fact key -> dim key."""
    side = dim.select(
        *[F.col(d).alias(f"_k{i}") for i, d in enumerate(on.values())], *cols
    )
    cond = [F.col(f) == F.col(f"_k{i}") for i, f in enumerate(on)]
    return fact.join(side, cond, how).drop(*[f"_k{i}" for i in range(len(on))])


#: Levels of dyadic nodes: 2**23 days are more than all of a date's range.
LEVELS = 23


def flag_intervals(
    series: DataFrame,
    intervals: DataFrame,
    key: str = "series",
    date: str = "date",
    start: str = "start",
    end: str = "end",
    label: str | None = None,
) -> DataFrame:
    """Whether a series date lies inside an interval of its key, both ends in.

    An interval is cut into dyadic nodes, blocks of 2**level days that start at
    a multiple of their length: at most two of each level, whatever its length.
    A day lies in one node of each level, so the range join becomes an equi join
    on (key, level, node) that spreads a hot key. Days look up only levels that
    occur. Overlapping intervals do not double a row; one that ends before it
    begins, or lacks an end, holds no day. With ``label`` the names of all
    intervals that hold the day come as a sorted array.
    """
    first, after = F.unix_date(start), F.unix_date(end) + 1
    level = F.sequence(F.lit(0), F.lit(LEVELS))

    def nodes(j: Column) -> Column:
        step = F.pow(F.lit(2.0), j)
        low, high = F.ceil(first / step).cast("int"), F.floor(after / step).cast("int")
        odd = lambda c: (low < high) & (F.pmod(c, F.lit(2)) == 1)
        return F.array(F.when(odd(low), F.struct(j.alias("level"), low.alias("node"))), F.when(odd(high), F.struct(j.alias("level"), (high - 1).alias("node"))))

    parts = intervals.select(
        F.col(key).alias("_k"), F.explode(F.array_compact(F.flatten(F.transform(level, nodes)))).alias("_n"), *([F.col(label).alias("_l")] if label else [])
    ).select("_k", "_n.level", "_n.node", *(["_l"] if label else []))
    found = series.select(F.col(key).alias("_k"), F.col(date).alias("_d")).filter("_d is not null").distinct()
    found = found.select("_k", "_d", F.explode(level).alias("level")).join(F.broadcast(parts.select("level").distinct()), "level", "left_semi")
    found = found.withColumn("node", F.floor(F.unix_date("_d") / F.pow(F.lit(2.0), "level")).cast("int"))
    days = found.join(parts, ["_k", "level", "node"])
    names = [F.sort_array(F.collect_set("_l")).alias("labels")] if label else []
    days = days.groupBy("_k", "_d").agg(F.lit(True).alias("inside"), *names)
    joined = series.join(days, (series[key] == days._k) & (series[date] == days._d), "left").drop("_k", "_d")
    return joined.withColumn("inside", F.coalesce("inside", F.lit(False)))


def align_horizons(
    fcst: DataFrame, obs: DataFrame, key: Sequence[str] = ("series",), origin: str = "origin",
    h: str = "h", date: str = "date", value: str = "value", forecast: str = "forecast",
) -> DataFrame:
    """Forecast at horizon h beside the observation h days after its origin."""
    key = list(key)
    o = obs.select(*[F.col(k).alias(f"_{k}") for k in key], F.col(date).alias("_date"), F.col(value).alias("observed"))
    f = fcst.withColumn("_target", F.date_add(F.col(origin), F.col(h).cast("int")))
    cond = [F.col(k) == F.col(f"_{k}") for k in key] + [F.col("_target") == F.col("_date")]
    return f.join(o, cond, "inner").select(
        *key, origin, h, F.col("_target").alias("target_date"), F.col(forecast).alias("forecast"), "observed"
    )


def align(a: DataFrame, b: DataFrame, key: Sequence[str] = ("series", "date")) -> DataFrame:
    """Two series side by side where both have the (key, date)."""
    return a.join(b, list(key), "inner")


def prev_days(
    df: DataFrame, n: int = 7, key: str = "series", date: str = "date", value: str = "value"
) -> DataFrame:
    """Values, mean and count of the ``n`` calendar days before each row."""
    w = W.partitionBy(key).orderBy(day_number(date)).rangeBetween(-n, -1)
    return df.withColumns({
        "prev_values": F.collect_list(value).over(w),
        "prev_mean": F.avg(value).over(w),
        "prev_count": F.count(value).over(w),
    })


def grid(df: DataFrame, params: Mapping[str, Sequence]) -> DataFrame:
    """Each row once per combination of the given parameter lists.

    The combinations are a literal array numbered in list order (``grid_id``),
    exploded on the row; no cross join.
    """
    combos: list[dict] = [{}]
    for name, values in params.items():
        combos = [{**c, name: v} for c in combos for v in values]
    structs = [
        F.struct(F.lit(i).alias("grid_id"), *[F.lit(v).alias(k) for k, v in c.items()])
        for i, c in enumerate(combos)
    ]
    return df.select("*", F.inline(F.array(*structs)))
