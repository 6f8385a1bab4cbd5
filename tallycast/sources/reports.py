"""Daily report files, series tables and snapshot files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions.dates import day_of
from ..functions.text import to_double
from ..session import write_out

REPORT_COLUMNS = ["Country_Region", "Confirmed", "Deaths", "Recovered", "date"]
REPORT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REPORT_COLUMNS])

_OLD_NAME = "Country/Region"
_NEW_NAME = "Country_Region"


def read_reports(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header, every column text.

    The columns are those of the schema, or of the first file. A file with
    another header fails the job; ``read_drifting_reports`` reads such folders.
    A folder named ``extract_date=...`` becomes a partition column, and a filter
    on it prunes the folders read.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return (reader if schema is None else reader.schema(schema)).csv(path)


# One cell of a line and what ends it: text in quotes, in which a quote is doubled, or anything up to the next comma.
_CELL = r'("(?:[^"]|"")*"|[^,]*)(?:,|$)'


def _cells(line: Column) -> Column:
    """Cells of a CSV line, quotes taken off, blank cells null."""
    raw = F.regexp_extract_all(line, F.lit(_CELL), F.lit(1))
    bare = lambda c: F.when(c.startswith('"') & (F.length(c) > 1), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(raw, lambda c: F.nullif(bare(c), F.lit("")))


def read_drifting_reports(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] = REPORT_COLUMNS, days: Sequence | None = None,
) -> DataFrame:
    """Report files of any number of header layouts, read as one table.

    Each file keeps its own header, its first line that is not blank: it says at which
    position a column stands, however many there are. The first lines, one row
    per file, are found by row number and joined to the lines of their file. Columns a layout lacks are null; a
    line that repeats the header of its file is no row. A file whose first
    line does not name the country column fails the job. A cell may hold commas
    in quotes but no line end. ``days`` keeps both passes to the folders of
    these collection dates.
    """
    raw = spark.read.text(path)
    if days is not None:
        raw = raw.filter(F.col("extract_date").isin(list(days)))
    folder = [c for c in raw.columns if c != "value"]
    lines = raw.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), *folder,
        F.ltrim(F.col("value"), F.lit("\ufeff")).alias("_line"),
    ).filter(F.trim("_line") != "")
    # A file begins in one task, which numbers its lines in their order; only lines that may be a header carry their text.
    number = F.monotonically_increasing_id()
    named = F.col("_line").contains(_NEW_NAME) | F.col("_line").contains(_OLD_NAME)
    heads = lines.filter("_block = 0").select("_file", number.alias("_n"), F.when(named, F.col("_line")).alias("_head"))
    heads = heads.groupBy("_file").agg(
        F.min("_n").alias("_first"), F.sort_array(F.collect_list(F.when(F.col("_head").isNotNull(), F.struct("_n", "_head"))))[0].alias("_h")
    )
    known = (F.col("_h._n") == F.col("_first")) & F.arrays_overlap(_cells(F.col("_h._head")), F.array(F.lit(_NEW_NAME), F.lit(_OLD_NAME)))
    heads = write_out(heads.select("_file", F.when(known, F.col("_h._head")).alias("_head")), "headers")
    joined = lines.join(heads.withColumn("_names", _cells(F.col("_head"))), "_file", "left")
    missing = F.raise_error(F.concat(F.lit("no country column in the first line of "), F.col("_file"))).cast("string")
    names = F.when(F.col("_head").isNull(), F.array(missing)).otherwise(F.col("_names"))
    rows = joined.filter(F.col("_head").isNull() | (F.col("_line") != F.col("_head"))).select(
        *folder, names.alias("_names"), _cells(F.col("_line")).alias("_cells")
    )

    def at(name: str) -> Column:
        return F.try_element_at("_cells", F.nullif(F.array_position("_names", F.lit(name)).cast("int"), F.lit(0)))

    named_columns = [at(c).alias(c) for c in columns if c != _NEW_NAME]
    return rows.select(F.coalesce(at(_NEW_NAME), at(_OLD_NAME)).alias(_NEW_NAME), *named_columns, *folder)


def normalise_header(df: DataFrame) -> DataFrame:
    """One name for the country column, whichever header the file had."""
    if _OLD_NAME not in df.columns:
        return df
    if _NEW_NAME not in df.columns:
        return df.withColumnRenamed(_OLD_NAME, _NEW_NAME)
    return df.withColumn(_NEW_NAME, F.coalesce(_NEW_NAME, F.col(f"`{_OLD_NAME}`"))).drop(_OLD_NAME)


def select_measures(df: DataFrame, measures=("Confirmed", "Deaths", "Recovered"), extra=()) -> DataFrame:
    """Country, date and the measures as double; text that is no number is null."""
    fixed = normalise_header(df)
    return fixed.select(
        _NEW_NAME, "date", *[to_double(m).alias(m) for m in measures], *extra
    )


def with_extract_date(df: DataFrame, source: Column | None = None, col: str = "date") -> DataFrame:
    """The day a row was collected, from its folder, as ``MM-dd-yyyy`` text."""
    if source is None:
        if "extract_date" in df.columns:
            source = F.col("extract_date").cast("string")
        else:
            source = F.regexp_extract(
                F.col("_metadata.file_path"), r"extract_date=(\d{4}-\d{2}-\d{2})", 1
            )
    return df.withColumn(col, F.date_format(day_of(source), "MM-dd-yyyy"))


def stamp(df: DataFrame, col: str, value) -> DataFrame:
    """Constant column: collection date, country code, table name."""
    return df.withColumn(col, F.lit(value))


def read_series(spark: SparkSession, path: str, keys: list | None = None, key: str = "country") -> DataFrame:
    """Parquet series of all countries; ``keys`` prunes folders when the table
    is partitioned by the key, and is pushed to the scan when it is not."""
    df = spark.read.parquet(path)
    return df if keys is None else df.filter(F.col(key).isin(list(keys)))


SNAPSHOT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["Country", "Date", *C.SNAPSHOT_NUMBERS]]
)


def read_snapshots(spark: SparkSession, glob: str | list[str], schema: T.StructType = SNAPSHOT_SCHEMA) -> DataFrame:
    """All snapshot files that match, as one table."""
    return spark.read.option("header", True).schema(schema).csv(glob)


def load_csv_fact(
    spark: SparkSession, path: str, table: str, schema: T.StructType | str, partition_by: list[str] | None = None
) -> DataFrame:
    """Bulk load of a CSV file into the fact table at path ``table``."""
    facts = spark.read.option("header", True).schema(schema).csv(path)
    writer = facts.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(table)
    return spark.read.parquet(table)
