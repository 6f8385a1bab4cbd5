"""Links between the tokens of two tokenizers, scored over the corpus by inverted pair bitmaps."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_out
from .arrays import column, give_back
from .packing import encoder
from .token_counts import byte_symbols, vocabulary_path

#: Documents of a block: their numbers in it are 16 bits.
BLOCK_ROWS = 1 << 16
#: Links from which on a block is closed (memory: some 24 bytes a link), and bytes of text tokenised at once.
BLOCK_LINKS, BATCH_BYTES = 1_500_000, 1 << 20
#: From so many documents on a container is a bitmap of 8 kB instead of a list of two bytes each.
DENSE = 4096


class Sides:
    """Both tokenizers: ids of texts and the bytes of each id."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece

        self.a = encoder(byte_level)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        size = self.a.max_token_value + 1
        self.a_bytes = [b""] * size
        for i in self.a._mergeable_ranks.values():
            self.a_bytes[i] = self.a.decode_single_token_bytes(i)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.b_size = len(self.b_bytes)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        names = [str(i).encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        #: each id followed by each separator: next of the group, other side, next group, end
        self.written = [n + s for s in (b",", b"|", b";", b"") for n in names]
        self.stride = len(names)

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of blank + text on both sides; none where a side's bytes are not those of blank + text."""
        none = np.zeros(0, np.int64)
        a_ids, b_ids = [], []
        at_a, at_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for text, b in zip(texts, self.b.encode(texts, num_threads=1) if texts else []):
            if not text:
                a_ids.append(none)
                b_ids.append(none)
                continue
            whole = " " + text
            a, raw = self.a.encode_ordinary(whole), whole.encode()
            same = b"".join(map(at_b, b)) == raw and b"".join(map(at_a, a)) == raw
            a_ids.append(np.array(a, np.int64) if same else none)
            b_ids.append(np.array(b, np.int64) if same else none)
        return a_ids, b_ids

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the tokens a and among b whose ends fall together: the last ones of each group."""
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a) if len(ends_b) else at[:0]
        return last_a, at[last_a]

    def spelled(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        if not len(a):
            return b""
        n = len(a) + len(b)
        sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        group_a, group_b = (np.repeat(np.arange(len(s)), s) for s in (sizes_a, sizes_b))
        b_before, a_until = last_b + 1 - sizes_b, last_a + 1
        code = np.empty(n, np.int64)
        code[np.arange(len(a)) + b_before[group_a]] = a
        code[np.arange(len(b)) + a_until[group_b]] = b
        code[last_a + b_before] += self.stride
        code[last_b + a_until] += 2 * self.stride
        code[-1] += self.stride
        return b"".join(map(self.written.__getitem__, code.tolist()))


_workers: dict[tuple[str, str], Sides] = {}


def _sides(byte_level: str, pieces: str) -> Sides:
    if (byte_level, pieces) not in _workers:
        _workers[byte_level, pieces] = Sides(byte_level, pieces)
    return _workers[byte_level, pieces]


def containers(keys: np.ndarray, rows: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(keys, planes): for each key a list of compressed sets of rows; the j-th holds the rows whose multiplicity has bit j.

    The input is sorted by (key, row), each pair once, with its multiplicity. A
    set is its 16-bit row numbers in order, or a bitmap of all ``BLOCK_ROWS``
    where it has more than ``DENSE``.
    """
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    heads = np.flatnonzero(new)
    which = np.cumsum(new) - 1
    most = np.maximum.reduceat(times, heads) if len(heads) else times
    planes = np.frexp(most.astype(np.float64))[1].astype(np.int64)  # bits of the largest multiplicity
    first = np.concatenate([[0], np.cumsum(planes)])
    slots, members = [], []
    for j in range(int(planes.max(initial=0))):
        has = np.flatnonzero(times >> j & 1)
        slots.append(first[which[has]] + j)
        members.append(rows[has])
    slot = np.concatenate([*slots, np.zeros(0, np.int64)])
    order = np.argsort(slot, kind="stable")
    member = np.concatenate([*members, np.zeros(0, np.int64)])[order].astype("<u2")
    counts = np.bincount(slot, minlength=first[-1]) if first[-1] else np.zeros(0, np.int64)
    sizes = np.where(counts > DENSE, BLOCK_ROWS // 8, 2 * counts)
    ends, at = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([[0], np.cumsum(counts)])
    dense = np.flatnonzero(counts > DENSE)
    if len(dense):
        raw, was = [], 0
        for s in dense:
            bits = np.zeros(BLOCK_ROWS, np.uint8)
            bits[member[at[s] : at[s + 1]]] = 1
            raw += [member[was : at[s]].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
            was = at[s + 1]
        data = b"".join([*raw, member[was:].tobytes()])
    else:
        data = member.tobytes()
    sets = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(data)])
    return keys[heads], pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), sets)


def members(planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, plane, row) of all members of a column of container lists."""
    sets, bounds = planes.flatten(), planes.offsets.to_numpy() - planes.offsets[0].as_py()
    ends = np.frombuffer(sets.buffers()[1], np.int32)[sets.offset : sets.offset + len(sets) + 1] if len(sets) else np.zeros(1, np.int32)
    data = sets.buffers()[2] if len(sets) else None
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    sizes = np.diff(ends)
    index = np.repeat(np.arange(len(planes)), np.diff(bounds))
    plane = np.arange(len(sets)) - bounds[:-1][index]
    thin = sizes != BLOCK_ROWS // 8
    keep = np.repeat(thin, sizes)
    out = [(np.repeat(np.flatnonzero(thin), sizes[thin] // 2), data[ends[0] : ends[-1]][keep].view("<u2"))]
    for s in np.flatnonzero(~thin):
        has = np.flatnonzero(np.unpackbits(data[ends[s] : ends[s + 1]], bitorder="little"))
        out.append((np.full(len(has), s), has))
    which = np.concatenate([w for w, _ in out])
    return index[which], plane[which], np.concatenate([r for _, r in out]).astype(np.int64)


def _batches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``BATCH_BYTES``; a longer text is one of its own."""
    sizes = np.cumsum(texts.to_pandas().str.len().to_numpy(np.int64)) if len(texts) else np.zeros(0, np.int64)
    lo = 0
    while lo < len(sizes):
        hi = int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BATCH_BYTES, "right"))
        yield lo, max(hi, lo + 1)
        lo = max(hi, lo + 1)


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def linked(docs: DataFrame, byte_level: str, pieces: str, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Two sorts of rows from one reading of the texts: documents (with ``row`` in ``block``) and postings (``pair`` in ``block``).

    Documents are numbered within a block, which ends by rows or by links; a
    block's postings are the inverted index of its links: for each pair of ids
    the containers of the documents that link it. Blocks are numbered within
    their task, so the rows must be written out before use.
    """
    fields = f"block long, row int, {DOCUMENT}, pair long, planes array<binary>"
    names = [f.split()[0] for f in fields.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.int64(), pa.list_(pa.binary())]

    def table(n: int, cols: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in zip(names, types)], names)

    def rows(batches):
        sides, block, nth = _sides(byte_level, pieces), TaskContext.get().partitionId() << 32, 0
        found, n_found = [], 0

        def postings(block, found):
            if not found:
                return
            key, times = np.unique(np.concatenate(found), return_counts=True)
            pairs, planes = containers(key >> 16, key & 0xFFFF, times)
            for lo in range(0, len(pairs), 50_000):
                part = slice(lo, lo + 50_000)
                yield table(len(pairs[part]), {"block": np.full(len(pairs[part]), block), "pair": (pairs[part] // sides.b_size << 32) | pairs[part] % sides.b_size, "planes": planes[part]})

        for batch in batches:
            texts = column(batch.column(1))
            for lo, hi in _batches(texts):
                out = {n: [] for n in ("block", "row", "n_a", "n_b", "n_links", "groups_sha256")}
                for a, b in zip(*sides.ids(texts.slice(lo, hi - lo).to_pylist())):
                    if nth == BLOCK_ROWS or n_found >= block_links:
                        yield from postings(block, found)
                        block, nth, found, n_found = block + 1, 0, [], 0
                    last_a, last_b = sides.cuts(a, b)
                    digest = hashlib.sha256(sides.spelled(a, b, last_a, last_b)).hexdigest() if len(a) else ""
                    if len(a):
                        found.append((a[last_a] * sides.b_size + b[last_b]) << 16 | nth)
                    n_found += len(last_a)
                    for c, v in zip(out.values(), (block, nth, len(a), len(b), len(last_a), digest)):
                        c.append(v)
                    nth += 1
                yield table(hi - lo, out | {"doc_id": batch.column(0).slice(lo, hi - lo), "n_groups": out["n_links"]})
        yield from postings(block, found)
        give_back()

    return docs.select("doc_id", "text").mapInArrow(rows, fields)


def pair_scores(postings: DataFrame) -> DataFrame:
    """(pair, n_docs, n_links, is_best) of each pair: documents and links that hold it, and whether no pair of its B id has more links.

    The planes of a block are merged by OR and popcounted for documents; each
    plane is popcounted and weighted by its power of two for links. Blocks hold
    different documents, so Spark adds their counts, first on the map side: no
    pair is one task's work, however many documents hold it.
    """

    def counts(batches):
        for batch in batches:
            index, plane, row = members(batch.column(1))
            n, times = batch.num_rows, np.zeros(batch.num_rows, np.int64)
            np.add.at(times, index, np.int64(1) << plane)
            held = np.bincount(np.unique(index << 16 | row) >> 16, minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.int64()), pa.array(times)], ["pair", "n_docs", "n_links"])

    per_block = postings.select("pair", "planes").mapInArrow(counts, "pair long, n_docs long, n_links long")
    pairs = write_out(per_block.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")), "pairs")
    b_id = F.col("pair").bitwiseAND((1 << 32) - 1)
    best = pairs.groupBy(b_id.alias("b_id")).agg(F.max("n_links").alias("most"))
    scored = pairs.withColumn("b_id", b_id).join(best, "b_id")
    return scored.select("pair", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("is_best"))


def document_scores(postings: DataFrame, scores: DataFrame) -> DataFrame:
    """(block, row, n_best, count_sum): the scores of pairs handed back along their postings.

    A posting takes its pair's score, then a block's postings meet in one task.
    A block is bounded (``BLOCK_ROWS``, ``BLOCK_LINKS`` and one more text).
    """

    def fold(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_best, total, seen = (np.zeros(BLOCK_ROWS, t) for t in (np.int64, np.int64, bool))
        for batch in batches:
            get = {c: batch.column(batch.schema.get_field_index(c)) for c in ("planes", "n_links", "is_best")}
            index, plane, row = members(get["planes"])
            times = np.int64(1) << plane
            np.add.at(total, row, times * get["n_links"].to_numpy()[index])
            np.add.at(n_best, row, times * get["is_best"].to_numpy(zero_copy_only=False)[index])
            seen[row] = True
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), key[0].as_py()), pa.int64()), pa.array(at, pa.int32()), pa.array(n_best[at]), pa.array(total[at])], ["block", "row", "n_best", "count_sum"]
        )

    scored = postings.select("block", "pair", "planes").join(scores.select("pair", "n_links", "is_best"), "pair")
    return scored.groupBy("block").applyInArrow(fold, "block long, row int, n_best long, count_sum long")


def token_links(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, block_links: int = BLOCK_LINKS) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): a row for each document and one for each pair of ids that ends together anywhere.

    Documents have doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256; pairs have a_id, b_id, n_docs, n_links and is_best. A null or
    empty text, and one that a tokenizer does not give back byte by byte, has
    zeros and ''. Rows count as often as they occur, also with equal ids; a null
    doc_id stays null. Other columns are not read. No documents give no rows.
    The files must be at these paths on every executor.
    """
    files = byte_level or vocabulary_path(), pieces or vocabulary_path("piece_bpe_32k.model")
    rows = write_out(linked(docs, *files, block_links), "token_links")
    postings = rows.filter("pair is not null").select("block", "pair", "planes")
    scores = write_out(pair_scores(postings), "pair_scores")
    found = document_scores(postings, scores)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    documents = rows.filter("pair is null").join(found, ["block", "row"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
    ids = [F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND((1 << 32) - 1).cast("int").alias("b_id")]
    return documents, scores.select(*ids, "n_docs", "n_links", "is_best")


def op13_token_links(spark: SparkSession, sf: str) -> DataFrame:
    return token_links(spark.read.parquet(f"{sf}/documents.parquet"))[0]
