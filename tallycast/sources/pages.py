"""Stored API pages: one JSON document per line, tweets and users nested."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("author_id", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("text", T.StringType()),
    ]))),
    T.StructField("includes", T.StructType([
        T.StructField("users", T.ArrayType(T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("location", T.StringType()),
        ]))),
    ])),
    T.StructField("meta", T.StructType([T.StructField("next_token", T.StringType())])),
])


def read_pages(spark: SparkSession, path: str | list[str], schema: T.StructType = PAGE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def explode_structs(df: DataFrame, path: str, fields: Sequence[str]) -> DataFrame:
    """One row per element of an array of structs, with the named fields."""
    return df.select(F.explode(path).alias("_e")).select(*[F.col(f"_e.{f}").alias(f) for f in fields])


def tweets_of(pages: DataFrame) -> DataFrame:
    return explode_structs(pages, "data", ["author_id", "created_at", "text"])


def users_of(pages: DataFrame) -> DataFrame:
    return explode_structs(pages, "includes.users", ["id", "location"])


def incomplete_chains(pages: DataFrame, chain: Column | str | None = None) -> DataFrame:
    """Collected files in which not exactly one page lacks a next token.

    ``chain`` names the file of a page; left out, it is the path the page was
    read from.
    """
    name = F.col("_metadata.file_path") if chain is None else (F.col(chain) if isinstance(chain, str) else chain)
    ends = F.count_if(F.col("meta.next_token").isNull())
    counted = pages.select(name.alias("chain"), "meta").groupBy("chain").agg(
        F.count(F.lit(1)).alias("pages"), ends.alias("last_pages")
    )
    return counted.filter(F.col("last_pages") != 1)
