"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", app: str = "tallycast") -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file:///tmp/tallycast/{os.getpid()}")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``, or else in the warehouse.

    Both can be reached by all executors. What is written there is deleted when
    the session's JVM ends; ``drop_scratch`` deletes it earlier.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete what was written at a scratch path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_out(df, label: str):
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def task_count(spark: SparkSession) -> int:
    """Tasks for Python work. Given as a number, so that adaptive execution
    does not merge a few small but slow partitions into one task."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )


def spread_scan(df, *keys: str):
    """Rows of a plain file scan over all cores, where the files are too few.

    A file with one row group is one task, however heavy the work on its rows.
    Data with at least as many splits as cores is left as it is, so nothing is
    shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
