"""New day folders into the history table, each file read once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import group_reports
from ..operators.sinks import read_table, replace_partitions, upsert, with_grain
from ..session import drop_scratch, scratch_path
from ..sources.reports import REPORT_SCHEMA, read_drifting_reports, select_measures
from ..functions.dates import parse_date

KEYS = ["Country_Region", "date"]


def merge_days(
    new: DataFrame, table: str, keys: Sequence[str] = KEYS, order: Sequence[str] = ("extract_date",), by: str = "date",
    grain: str = "month",
) -> None:
    """Upsert into a Parquet table partitioned by time (column ``part``).

    Only the partitions that ``new`` falls into are read and replaced. Their
    dates, at most one per day of the calendar, are fetched to become literals
    in the filter, so that other folders are not even listed for the scan. The
    merged rows are written to the shared folder first, and deleted there at the
    end: the table is not read while it is replaced, and a lost executor costs
    tasks, not data. Rows without a date keep to a partition of their own.
    Running the same batch again gives the same table.
    """
    spark = new.sparkSession
    staged = scratch_path(spark, "merge")
    rows = with_grain(new, by, grain)
    days = distinct_days(rows, "part")
    old = read_table(spark, table, rows.schema)
    if old is not None:
        touched = F.col("part").isin([d for d in days if d is not None])
        old = old.filter(touched | F.col("part").isNull() if None in days else touched).select(*rows.columns)
    upsert(rows, old, keys, order).write.parquet(staged)
    replace_partitions(spark.read.schema(rows.schema).parquet(staged), table, ["part"])
    drop_scratch(spark, staged)


def distinct_days(df: DataFrame, col: str) -> list:
    """The days in a date column, and None if any is missing; their number is bounded by the calendar."""
    return [r[0] for r in df.select(F.col(col).cast("date")).distinct().collect()]


def report_rows(reports: DataFrame) -> DataFrame:
    """Raw report rows to sums by country and day of each collected folder."""
    collected = F.col("extract_date").cast("date")
    rows = reports.withColumn("extract_date", collected).withColumn("date", F.coalesce(parse_date("date"), collected))
    rows = select_measures(rows, extra=("extract_date",))
    return group_reports(rows, ("Country_Region", "date", "extract_date"))


def ingest_new_days(
    spark: SparkSession, src: str, table: str, checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = report_rows, max_files: int | None = None,
) -> None:
    """Read the folders that came since the last run and merge them.

    A folder whose files arrive in several batches is summed anew from all its
    files: the batch only says which folders changed. Files are read by their
    own headers. A day collected again in
    a later folder replaces the earlier one.
    """
    full = T.StructType([*REPORT_SCHEMA.fields, T.StructField("extract_date", T.DateType())])
    reader = spark.readStream.schema(full).option("header", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def merge(batch: DataFrame, _: int) -> None:
        days = distinct_days(batch, "extract_date")
        if None in days:
            raise ValueError("a file lies outside the extract_date= folders")
        if days:
            merge_days(transform(read_drifting_reports(batch.sparkSession, src, days=days)), table)

    query = (
        reader.csv(src).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


__all__ = ["ingest_new_days", "merge_days", "report_rows"]
