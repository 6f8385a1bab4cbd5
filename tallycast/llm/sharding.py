"""Weighted rendezvous sharding of records, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import write_out

#: Hexadecimal digits that make a number (52 bits, so a double holds it), and numbers taken from one SHA-256.
DIGITS, NUMBERS = 13, 4
#: Hexadecimal digits of a record's digest that number its block within a shard.
BLOCK_DIGITS = 3


def _bids(key: Column, weights: Sequence[float]) -> Column:
    """(wait, shard) of each shard: exponential waiting times with the weights as rates, so the least one wins in proportion."""
    digests = F.transform(F.sequence(F.lit(0), F.lit((len(weights) - 1) // NUMBERS)), lambda i: F.sha2(F.concat(key, F.lit(":"), i.cast("string")), 256))
    numbers = F.flatten(F.transform(digests, lambda d: F.array(*[F.substring(d, 1 + DIGITS * j, DIGITS) for j in range(NUMBERS)])))
    rates = F.array(*[F.lit(float(w)) for w in weights])

    def bid(digits: Column, shard: Column) -> Column:
        u = (F.conv(digits, 16, 10).cast("long") + 0.5) / float(16**DIGITS)
        rate = F.get(rates, shard)
        return F.struct(F.when(rate > 0, -F.ln(u) / rate).otherwise(float("inf")).alias("wait"), shard.alias("shard"))

    return F.transform(F.slice(numbers, 1, len(weights)), bid)


def shards_of(key: Column, weights: Sequence[float], counts: Sequence[int] | None = None) -> Column:
    """For each n of ``counts`` (by default all) the shard, 0 to n - 1, that wins a text key among the first n; an array.

    A shard's bid depends on the key and its own number and weight alone. So one
    more shard takes keys only into itself, and a changed weight moves keys only
    to or from that shard. Ties go to the smaller number. A shard of weight 0
    takes no key. A null key counts as ''.
    """
    counts = counts or [len(weights)]
    if any(w < 0 for w in weights) or not all(any(weights[:n]) for n in counts):
        raise ValueError("weights must not be negative, and one must be above 0")
    # an array of one, so that the bids are made once for all counts
    bids = F.array(_bids(F.coalesce(key, F.lit("")), weights))
    return F.get(F.transform(bids, lambda b: F.array(*[F.array_min(F.slice(b, 1, n))["shard"] for n in counts])), F.lit(0))


def with_slots(rows: DataFrame, shard: Column, key: Sequence[str]) -> DataFrame:
    """Rows with ``shard`` and their places in it (``slot``), gapless from 0, in the order of a digest of the columns ``key``.

    A shard is never one task's work: equal rows are counted first (map side),
    then a shard's rows are numbered in 4,096 blocks by the leading digits of
    their digests, and each block starts where the blocks before it end. Places
    depend on the rows alone, not on files, tasks or partitions; rows that are
    equal take consecutive ones. The other columns must follow from ``key``.
    """
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count("*").alias("_copies"))
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]))
    counted = write_out(counted.select("*", shard.alias("shard"), digest.alias("_digest"), F.substring(digest, 1, BLOCK_DIGITS).alias("_block")), "shard_rows")
    sizes = counted.groupBy("shard", "_block").agg(F.sum("_copies").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("shard", "_block").orderBy("_digest", *key).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_first", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(bases, ["shard", "_block"])
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))
    placed = placed.select(*names, "shard", (F.col("_base") + F.col("_first")).alias("_first"), nth.alias("_nth"))
    return placed.select(*names, "shard", (F.col("_first") + F.col("_nth")).alias("slot"))


def sharded(docs: DataFrame, weights: Sequence[float], grown: float | None = 1.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row for each document.

    The law is ``key``: doc_id and the shards decide, nothing else. ``size`` is
    the text's UTF-8 bytes plus 8. ``grown_shard`` is the shard once one more of
    weight ``grown`` is there; it is ``shard`` or the new one. A null text
    counts as empty (size 8, checksum 0). All rows of one doc_id, and all
    without one, share a shard; a hot id makes its shard larger, but is spread
    over the shard's blocks if its texts differ, and counted if they are equal.
    Other columns are not read. No documents give no rows.
    """
    text, n = F.coalesce("text", F.lit("")), len(weights)
    shards = shards_of(F.col("doc_id").cast("string"), [*weights, grown] if grown else weights, [n, n + 1] if grown else [n])
    out = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shards.alias("_shards"),
    )
    out = with_slots(out, F.get("_shards", F.lit(0)), ["doc_id", "size", "text_crc32"])
    out = out.withColumn("grown_shard", F.get("_shards", F.lit(1)))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


SHARDS = 24


def op12_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharded(spark.read.parquet(f"{sf}/documents.parquet"), [1.0] * SHARDS)


def sharding_sql(shards: int = SHARDS) -> str:
    """The same in DuckDB for equal weights; CRC-32 is folded over the bytes of the text."""
    numbers = f"list_transform(range({shards + 1}), lambda i: ('0x' || substr(sha256(k || ':' || i // {NUMBERS}), (1 + {DIGITS} * (i % {NUMBERS}))::INT, {DIGITS}))::BIGINT)"
    return f"""WITH t AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce([i] || range(8),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i))),
        b AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, octet_length(encode(coalesce(text, ''))) + 8 AS size,
            [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS l FROM documents),
        c AS (SELECT doc_id, size, xor(list_reduce(l, lambda c, x: xor(c // 256, tab[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
            list_transform({numbers}, lambda x: -ln((x + 0.5::DOUBLE) / {float(16**DIGITS)}::DOUBLE)) AS waits FROM b, t),
        d AS (SELECT doc_id, size, text_crc32, (list_position(waits[:{shards}], list_min(waits[:{shards}])) - 1)::INT AS shard,
            (list_position(waits, list_min(waits)) - 1)::INT AS grown_shard,
            md5(coalesce(doc_id::VARCHAR, '') || '|' || size || '|' || text_crc32) AS digest FROM c)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard,
            row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id, size, text_crc32) - 1 AS slot, grown_shard FROM d"""


OP12_SQL = sharding_sql()
