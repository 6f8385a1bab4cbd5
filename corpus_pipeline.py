"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes what its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.decontamination import without_leaks
from tallycast.llm.near_dedup import near_classes
from tallycast.llm.packing import pack
from tallycast.llm.substrings import without_repeats
from tallycast.llm.toxicity import fit_toxicity, with_toxicity
from tallycast.session import scratch_path

#: Not expressible in SQL: the first stage is a trained classifier.
ORACLE_SQL = None
#: Documents from this probability on are toxic.
TOXIC_AT = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_toxicity(docs, model, "_toxic").filter(F.col("_toxic") < TOXIC_AT).drop("_toxic")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id of each class of near copies, once; documents without an id stay.

    Classes are of rows, known by id and text, so an id that stands for two texts joins nothing.
    """
    rid = F.xxhash64("doc_id", "text")
    rows = docs.filter("doc_id is not null").select("doc_id", rid.alias("_rid"), "text")
    classes = near_classes(rows.select(F.col("_rid").alias("doc_id"), "text")).distinct().withColumnRenamed("doc_id", "_rid")
    least = F.min(F.struct("doc_id", "_rid"))["_rid"].alias("_rid")
    first = rows.select("doc_id", "_rid").join(classes, "_rid").groupBy("class_id").agg(least).select("_rid")
    kept = docs.filter("doc_id is not null").withColumn("_rid", rid).join(first, "_rid", "left_semi").dropDuplicates(["_rid"])
    return kept.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere as well; those of which nothing is left go."""
    left = without_repeats(docs).filter("n_removed = 0 or n_removed < n_words")
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
