"""Table updates and exports. No coalesce to one file, no row on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..session import write_out
from .shape import drop_nulls, for_date


def merge_history(new: DataFrame, old: DataFrame) -> DataFrame:
    """Union by name without exact duplicates; a revised value adds a row."""
    return new.unionByName(old).dropDuplicates()


def upsert(new: DataFrame, old: DataFrame | None, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the highest ``order`` wins, new over old on a tie.

    ``old`` has one row per key, as this function makes it. The batch is
    reduced to one row per key first; the history is then only joined with the
    keys of the batch, never aggregated or sorted as a whole: a small batch is
    broadcast by its known size, else both sides are hashed. Null keys are equal.
    """
    rest = [c for c in new.columns if c not in keys]
    # The row itself ends the order, so that a tie is settled the same way in every run.
    rank = F.struct(*[F.col(c) for c in (order or [])], *[F.col(c) for c in rest])
    batch = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*").select(*new.columns)
    if old is None:
        return batch

    def side(df: DataFrame, *extra: Column) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *extra)

    def same(df: DataFrame) -> list[Column]:
        return [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]

    if not order:
        return batch.unionByName(old.select(*new.columns).join(side(batch), same(old), "left_anti"))
    came = side(batch, F.struct(*order).alias("_came"), F.lit(True).alias("_hit"))
    old = old.select(*new.columns)
    kept = old.join(came, same(old), "left").filter(F.col("_hit").isNull() | (F.struct(*order) > F.col("_came")))
    late = side(kept.filter("_hit"))
    return batch.join(late, same(batch), "left_anti").unionByName(kept.select(*new.columns))


def overwrite_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that ``df`` holds.

    The rebalance hint gathers a partition value into few files and splits it
    again when it is too large for one task.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path)
    )


def write_day_json(df: DataFrame, path: str, day: str | Column, col: str = "process_date") -> None:
    """JSON lines into ``process_date=`` folders; a re-run replaces its days."""
    value = F.lit(day) if isinstance(day, str) else day
    replace_partitions(df.withColumn(col, value.cast("string")), path, [col], "json")


def export_csv(df: DataFrame, path: str, by: str = "country") -> None:
    """CSV with a header, one folder per country; the whole path is the
    combined table."""
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite").option("header", True).partitionBy(by).csv(path)
    )


def quoted_lines(df: DataFrame, header: bool = True) -> DataFrame:
    """CSV lines in which text is quoted and numbers are not; null is ``""``.

    The header stands before the first row of each partition, so each file of
    the write starts with it; no shuffle may stand between this and the write.
    """
    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    cells = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        numeric = kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
        cells.append(F.coalesce(c.cast("string") if numeric else quoted(c.cast("string")), F.lit('""')))
    line = F.concat_ws(",", *cells)
    if not header:
        return df.select(line.alias("value"))
    names = ",".join('"' + n.replace('"', '""') + '"' for n in df.columns)
    # The low 33 bits of this id count the rows inside a partition.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return df.select(F.when(first, F.concat(F.lit(names + "\n"), line)).otherwise(line).alias("value"))


def export_csv_quoted(df: DataFrame, path: str, header: bool = True) -> None:
    quoted_lines(df, header).write.mode("overwrite").text(path)


JSON_COLUMNS = ["date", "location", "compound", "neg", "neu", "pos", "texto", "translation"]


def json_to_csv(spark: SparkSession, src: str, dest: str, schema, columns: Sequence[str] = JSON_COLUMNS) -> None:
    """Scored tweets from JSON to quoted CSV; a row with any null is dropped."""
    df = drop_nulls(spark.read.schema(schema).json(src))
    export_csv_quoted(df.select(*columns), dest)


# ---- warehouse ---------------------------------------------------------------


def with_id(df: DataFrame, natural_key: Sequence[str], col: str = "ID") -> DataFrame:
    """Surrogate ID from the natural key: the same row has the same ID in every
    run, and no global numbering is needed."""
    # The separator and the escape are escaped, so different keys give different texts.
    parts = []
    for name in natural_key:
        text = F.replace(F.col(name).cast("string"), F.lit("\\"), F.lit("\\\\"))
        parts.append(F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N")))
    return df.withColumn(col, F.md5(F.concat_ws("|", *parts)))


def to_fact(df: DataFrame, table: str, with_ids: bool = False) -> DataFrame:
    """Columns of the fact table, taken by name; a bad value becomes null."""
    cols = C.FACTS[table]
    fact = df.select(*[F.col(f"`{src}`").try_cast(kind).alias(name) for name, src, kind in cols])
    if with_ids:
        fact = with_id(fact, C.FACT_KEYS[table]).select("ID", *[c[0] for c in cols])
    return fact


GRAINS = {"day": "DD", "month": "month", "year": "year"}


def with_grain(df: DataFrame, date_col: str, grain: str, out: str = "part") -> DataFrame:
    """Partition column of a dated table: the first day of the month or year, or
    the day itself. Small tables want a coarse grain, or they become one tiny
    file per day; large ones want days, so that a load rewrites little."""
    c = F.col(date_col).cast("date")
    return df.withColumn(out, c if grain == "day" else F.trunc(c, GRAINS[grain]))


def load_fact(df: DataFrame, path: str, date=None, date_col: str = "CALENDARIO_data", grain: str = "month") -> None:
    """Load a fact table kept as Parquet, partitioned by time.

    Without ``date`` the whole table is replaced. With it only the rows of that
    day are replaced: a second run changes nothing. The partition of the day is
    the only one that is read and written.
    """
    if date is None:
        rows = with_grain(df, date_col, grain)
        rows.hint("rebalance", F.col("part")).write.mode("overwrite").partitionBy("part").parquet(path)
        return
    day = (date if isinstance(date, Column) else F.lit(date)).cast("date")
    new = with_grain(df.filter(F.col(date_col) == day), date_col, grain)
    if grain != "day":
        old = read_table(df.sparkSession, path, new.schema)
        if old is not None:
            start = F.trunc(day, GRAINS[grain])
            kept = old.filter((F.col("part") == start) & (F.col(date_col) != day)).select(*new.columns)
            # Written first: the partition is not read while it is replaced.
            new = write_out(new.unionByName(kept), "fact")
    replace_partitions(new, path, ["part"])


def read_table(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("part")


def load_gold(df: DataFrame, table: str, path: str, date=None) -> None:
    """Complete export rows into their fact table: rows with a null are left out,
    and with a date only that day is loaded."""
    rows = df if table == "COVID_WORLDOMETER" else drop_nulls(df)
    if date is not None:
        rows = for_date(rows, date)
    load_fact(to_fact(rows, table, with_ids=True), path, date, grain=C.FACT_GRAINS[table])


def check_keys(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows whose key is missing in a dimension, with the failing column.

    ``dims`` maps a fact column to (dimension, key column). A null key refers
    to nothing and is no error. The fact is read once and joined with the
    distinct keys of each dimension: small ones are broadcast by their known
    size, for others adaptive execution splits the rows of a hot key.
    """
    rows = fact
    for i, (col, (dim, dim_key)) in enumerate(dims.items()):
        side = dim.select(F.col(dim_key).alias(f"_d{i}")).distinct().withColumn(f"_in{i}", F.lit(True))
        rows = rows.join(side, rows[col] == side[f"_d{i}"], "left").drop(f"_d{i}")
    missing = [F.when(F.col(c).isNotNull() & F.col(f"_in{i}").isNull(), F.lit(c)) for i, c in enumerate(dims)]
    return rows.select(*fact.columns, F.explode(F.array_compact(F.array(*missing))).alias("missing"))


def save_models(models: DataFrame, path: str) -> None:
    """Fitted parameters, one row per series."""
    models.write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

