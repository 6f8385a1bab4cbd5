"""Best-fit packing of tokenised documents, planned on a histogram of lengths."""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import write_out
from .arrays import column
from .token_counts import byte_symbols, vocabulary_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"


_workers: dict[str, object] = {}


def encoder(path: str):
    """The byte-level BPE of a ``tokenizers`` file; its ids are the ranks of its merges.

    The file's own library gives the same ids (the tests compare them) at twice
    the CPU time. Special tokens in a text are single ids in both.
    """
    if path not in _workers:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        symbol = byte_symbols()
        ranks = {bytes(symbol[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        _workers[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _workers[path]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; the first may be shorter."""
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))] if n > size else [(0, n)]


def token_pieces(docs: DataFrame, size: int = 2048, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """Pieces of each document: its ids, then ``end_id``; longer ones are cut.

    ``task`` and ``nth`` number the pieces of equal length within the task that
    made them. They are only stable once written, so write this out before use.
    """
    path = tokenizer or vocabulary_path()
    last = np.array([end_id], "<u4").tobytes()

    def rows(batches):
        tokens, task = encoder(path), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), column(batch.column(1))):
                ids = tokens.encode_to_numpy(text.as_py(), allowed_special="all")
                raw = memoryview(ids.astype("<u4").tobytes() + last)
                for k, (start, length) in enumerate(cut(len(raw) // 4, size)):
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    row = (doc_id, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), task, nth)
                    for c, v in zip(out, row):
                        c.append(v)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], [f.split()[0] for f in PIECES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(rows, PIECES)


@dataclass
class _Bins:
    """Sequences that are filled alike: ``count`` of them from ``first`` on, ``used`` tokens in each."""

    first: int
    count: int
    used: int


@dataclass
class Plan:
    """Slots: ranks [rank, rank + count * per_bin) of a length go to sequences from ``first`` on, ``per_bin`` to each."""

    slots: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0


def best_fit(histogram: dict[int, int], size: int) -> Plan:
    """Best-fit decreasing over counts of lengths.

    Lengths come in falling order; each count goes to the fullest sequences
    that it still fits, class by class, as many of the length to a sequence as
    fit. Time and size depend on the number of lengths (at most ``size``), not
    on the number of documents.
    """
    plan = Plan()
    room: dict[int, list[_Bins]] = {}
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if length > size or length < 1:
            raise ValueError(f"a piece of {length} tokens does not fit sequences of {size}")

        def place(bins: _Bins, per_bin: int) -> None:
            nonlocal left, rank
            plan.slots.append((length, rank, bins.count, per_bin, bins.first, bins.used))
            left -= bins.count * per_bin
            rank += bins.count * per_bin
            bins.used += per_bin * length
            if bins.used < size:
                room.setdefault(size - bins.used, []).append(bins)

        for gap in range(length, size):
            while left and room.get(gap):
                bins = room[gap].pop()
                per_bin = gap // length
                full = min(bins.count, left // per_bin)
                if full == 0:
                    per_bin, full = left, 1
                if full < bins.count:
                    room[gap].append(_Bins(bins.first + full, bins.count - full, bins.used))
                place(_Bins(bins.first, full, bins.used), per_bin)
            if not left:
                break
        per_bin = size // length
        for count, each in ((left // per_bin, per_bin), (1, left % per_bin)):
            if count and each:
                bins = _Bins(plan.sequences, count, 0)
                plan.sequences += count
                place(bins, each)
    return plan


def pack(docs: DataFrame, size: int = 2048, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Documents are tokenised once; what is planned on is the count of each
    length, at most ``size`` numbers. A piece then takes the planned slot of its
    rank within its length: its number within its task plus the pieces of that
    length in earlier tasks. Repeated rows are packed as often as they occur. A
    null or empty text is one piece that holds ``end_id`` only. No documents
    give no rows.
    """
    pieces = write_out(token_pieces(docs, size, end_id, tokenizer), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = np.array(best_fit(histogram, size).slots, np.int64).reshape(-1, 6)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    heads = slots[:, 0] << 48 | slots[:, 1]  # rank below 2**48

    def place(batches):
        for batch in batches:
            length, nth, base = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "nth", "base"))
            rank = nth + base
            s = slots[np.searchsorted(heads, length << 48 | rank, "right") - 1]
            at = rank - s[:, 1]
            sequence, turn = s[:, 4] + at // s[:, 3], at % s[:, 3]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(s[:, 5] + turn * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "base")
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf}/documents.parquet"))
