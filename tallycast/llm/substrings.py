"""Repeated passages, found with prefix-partitioned suffix trees over words.

Suffixes are thinned before they are partitioned: of the word runs (``gram``
words) inside each window, the one with the least hash is the window's anchor.
Equal windows have equal anchors at equal places, so an anchor run that occurs
once in the corpus rules its windows out. Windows that share an anchor
occurrence are one stretch of text, and equal stretches are one leaf with a
multiplicity. The anchor run is the prefix that partitions the suffixes; the
subtree of each is grown top-down, level by level, to the right of the anchor
and, reversed, to its left. Internal nodes whose two depths make up a window
are its repeats. Prefixes with more leaves than fit a task are lengthened to
whole windows, which are counted with map-side sums.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_out
from .arrays import Words, blocks, column, mix, powers, window_hashes

_PLACE = np.uint64(28)  # bits for a word's place in its block


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key that equal rows share; a document without an id has one as well."""
    return docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("key"), F.xxhash64("doc_id", "text").alias("rid"), F.coalesce("text", F.lit("")).alias("text")
    )


def stretches(w: Words, h: np.ndarray, window: int, gram: int):
    """(anchor place, first window, last window, hash of the anchor run) of each stretch of a block."""
    width, n = window - gram + 1, len(h)
    none = np.zeros(0, np.int64)
    left = w.left()
    starts = np.flatnonzero(left >= window)
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    g, _ = window_hashes(h, gram, left)
    low = (g >> _PLACE << _PLACE) | np.arange(n, dtype=np.uint64)
    span = 1
    least = low
    while 2 * span <= width:
        least = np.minimum(least[: n - 2 * span + 1], least[span : n - span + 1])
        span *= 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    anchor = (least[starts] & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    return anchor[first], starts[first], starts[last], g[anchor[first]]


def _anchors(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, rid, g, c, lo, lead, n): each stretch with its anchor run, its own hash, place, words before the anchor and words."""
    names = ["key", "rid", "g", "c", "lo", "lead", "n"]

    def rows(batches):
        for batch in batches:
            key, rid = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for b, _, data, offsets in blocks(column(batch.column(2))):
                w = Words(data, offsets)
                h = w.hashes()
                at, lo, hi, g = stretches(w, h, window, gram)
                n, lead = hi + window - lo, at - lo
                p, inv = powers(len(h) + 1)
                q = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(mix(h + np.uint64(1)) * p[: len(h)], out=q[1:])
                c = mix((q[lo + n] - q[lo]) * inv[lo] + (n * 1009 + lead).astype(np.uint64))
                doc = w.owner()[lo] if len(lo) else lo
                cols = [key[b + doc], rid[b + doc], g.view(np.int64), c.view(np.int64), lo - w.bounds[doc], lead, n]
                kinds = [pa.int64()] * 4 + [pa.int32()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(x).cast(t) for x, t in zip(cols, kinds)], names)

    return keyed.mapInArrow(rows, "key long, rid long, g long, c long, lo int, lead int, n int")


def _leaves(joined: DataFrame, window: int) -> DataFrame:
    """Text of the stretches of small prefixes; of large ones each window, as two hashes."""
    names = ["g", "c", "lead", "words", "j", "w1", "w2", "m"]

    def rows(batches):
        for batch in batches:
            lists = batch.column(1)
            for b, e, data, offsets in blocks(column(batch.column(0))):
                w = Words(data, offsets)
                out = [[] for _ in names]
                hashes = None
                for i in range(b, e):
                    base, size = w.bounds[i - b], w.counts[i - b]
                    for x in lists[i].as_py():
                        lo, n = base + x["lo"], x["n"]
                        if x["lo"] + n > size:
                            raise ValueError("a stretch ends after its document")
                        if not x["large"]:
                            words = bytes(data[w.starts[lo] : w.stops[lo + n - 1]])
                            for col, v in zip(out, (x["g"], x["c"], x["lead"], words, None, None, None, x["m"])):
                                col.append(v)
                            continue
                        if hashes is None:
                            h = w.hashes()
                            hashes = [window_hashes(v, window, w.left())[0].view(np.int64) for v in (h, mix(h + np.uint64(7)))]
                        for j in range(n - window + 1):
                            row = (x["g"], x["c"], x["lead"], None, j, int(hashes[0][lo + j]), int(hashes[1][lo + j]), x["m"])
                            for col, v in zip(out, row):
                                col.append(v)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    return joined.select("text", "stretches").mapInArrow(rows, "g long, c long, lead int, words binary, j int, w1 long, w2 long, m long")


def _levels(base: np.ndarray, words: np.ndarray, depth: int) -> list[np.ndarray]:
    """Node of each leaf at the depths 0 to ``depth`` of a trie grown level by level; -1 once a leaf is alone."""
    node = base.copy()
    out = [node]
    for d in range(depth):
        live = np.flatnonzero(node >= 0)
        nxt = np.full(len(node), -1, np.int64)
        if len(live):
            key = mix(words[live, d] ^ mix(node[live].astype(np.uint64) + np.uint64(d << 40)))
            _, inv, count = np.unique(key, return_inverse=True, return_counts=True)
            nxt[live] = np.where(count[inv] > 1, inv, -1)
        node = nxt
        out.append(node)
    return out


def deep_nodes(group: np.ndarray, lead: np.ndarray, h: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """(from, to) in words of what each leaf shares with another one of its group; to = 0 where it is less than a window.

    Leaves are word hashes ``h`` cut at ``bounds``; ``lead`` words of each lie
    before the anchor.
    """
    n_leaves, before = len(group), window - gram
    size = np.diff(bounds)

    def matrix(step: int, start: np.ndarray, count: np.ndarray, depth: int) -> np.ndarray:
        at = start[:, None] + step * np.arange(depth)
        inside = np.arange(depth) < count[:, None]
        alone = mix((np.arange(n_leaves)[:, None] * depth + np.arange(depth) + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        return np.where(inside, h[np.where(inside, at, 0)], alone)

    _, base = np.unique(group, return_inverse=True)
    anchor = bounds[:-1] + lead
    right = _levels(base, matrix(1, anchor, size - lead, window), window)
    left = _levels(base, matrix(-1, anchor - 1, lead, before), before)
    first, last = np.full(n_leaves, 1 << 30), np.zeros(n_leaves, np.int64)
    for r in range(gram, window + 1):
        a, b = right[r], left[window - r]
        live = np.flatnonzero((a >= 0) & (b >= 0))
        if not len(live):
            continue
        _, inv, count = np.unique(a[live] * n_leaves + b[live], return_inverse=True, return_counts=True)
        hit = live[count[inv] > 1]
        first[hit] = np.minimum(first[hit], lead[hit] - (window - r))
        last[hit] = np.maximum(last[hit], lead[hit] + r)
    return first, last


def _subtrees(leaves: DataFrame, window: int, gram: int) -> DataFrame:
    """(g, c, from, to) of leaves with a deep node. Rows come sorted by prefix; a prefix cut off by a batch waits for the next."""

    def solve(g, c, lead, words):
        data = np.frombuffer(b"".join(words), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in words])]).astype(np.int64)
        w = Words(data, offsets)
        first, last = deep_nodes(g, lead, w.hashes(), w.bounds, window, gram)
        hit = last > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(g[hit]), pa.array(c[hit]), pa.array(first[hit].astype(np.int32)), pa.array(last[hit].astype(np.int32))], ["g", "c", "from", "to"]
        )

    def rows(batches):
        kept: list[tuple] = []
        for batch in batches:
            new = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            if not new:
                continue
            end = len(new)
            while end and new[end - 1][0] == new[-1][0]:
                end -= 1
            ready = kept + new[:end] if end or (kept and kept[0][0] != new[0][0]) else []
            kept = new[end:] if ready else kept + new
            if ready:
                yield from chunks(ready)
        if kept:
            yield from chunks(kept)

    def chunks(rows_):
        unique = list({(r[0], r[1]): r for r in rows_}.values())  # repeated document rows give a leaf twice
        g, c, lead = (np.array([r[k] for r in unique], np.int64) for k in range(3))
        yield solve(g, c, lead, [r[3] for r in unique])

    return leaves.select("g", "c", "lead", "words").repartition("g").sortWithinPartitions("g").mapInArrow(rows, "g long, c long, from int, to int")


def repeated_spans(docs: DataFrame, window: int = 35, gram: int = 8, leaves_per_prefix: int = 2000) -> DataFrame:
    """(key, rid, spans): word ranges of each document that repeats cover, as array<struct<from, to>>.

    A range lies inside the union of windows of ``window`` words whose words
    also start a window elsewhere; together the ranges cover that union.
    """
    keyed = _keyed(docs)
    anchors = write_out(_anchors(keyed, window, gram), "anchors")
    # Sides of joins are written where they are sums, so that adaptive execution can split a hot key of the other side.
    often = write_out(anchors.groupBy("g").agg(F.count("*").alias("k")).filter("k > 1").select("g"), "prefixes")
    found = write_out(anchors.join(often, "g", "left_semi"), "stretches")
    leaves = found.groupBy("g", "c").agg(F.count("*").alias("m"), F.min(F.struct("key", "rid", "lo", "lead", "n")).alias("at"))
    leaves = write_out(leaves, "distinct")
    per_prefix = write_out(leaves.groupBy("g").agg(F.count("*").alias("k")).filter("k > 1"), "sizes")
    shared = leaves.join(per_prefix, "g").select("g", "c", "m", "at.*", (F.col("k") > leaves_per_prefix).alias("large"))
    by_doc = shared.groupBy("key", "rid").agg(F.collect_list(F.struct("g", "c", "m", "lo", "lead", "n", "large")).alias("stretches"))
    content = write_out(_leaves(keyed.join(by_doc, ["key", "rid"]), window), "leaves")
    trees = _subtrees(content.filter("words is not null"), window, gram)
    windows = content.filter("words is null").select("w1", "w2", "g", "c", "j", "m").distinct()
    deep = windows.groupBy("w1", "w2").agg(F.sum("m").alias("k")).filter("k > 1")
    large = windows.join(write_out(deep, "deep"), ["w1", "w2"]).groupBy("g", "c").agg(F.min("j").alias("from"), (F.max("j") + window).alias("to"))
    shares = trees.unionByName(large).withColumn("m", F.lit(1).cast("long"))
    copies = leaves.filter("m > 1").select("g", "c", F.lit(0).alias("from"), F.col("at.n").alias("to"), "m")
    ranges = write_out(shares.unionByName(copies).groupBy("g", "c").agg(F.min("from").alias("from"), F.max("to").alias("to")), "ranges")
    spans = found.join(ranges, ["g", "c"]).select("key", "rid", (F.col("lo") + F.col("from")).alias("from"), (F.col("lo") + F.col("to")).alias("to"))
    return spans.distinct().groupBy("key", "rid").agg(F.collect_list(F.struct("from", "to")).alias("spans"))


def without_repeats(docs: DataFrame, window: int = 35, gram: int = 8, leaves_per_prefix: int = 2000) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_sha256; ``text`` is the kept words joined by blanks where any was removed.

    Words are split at blanks, tabs and line ends. A word goes if a window that
    covers it occurs anywhere else, in the same document or a repeated row as
    well; all windows are judged on the input. A null text has no words and
    stays null; texts shorter than ``window`` words stay as they are.
    """
    spans = repeated_spans(docs, window, gram, leaves_per_prefix)
    keyed = docs.select("*", F.coalesce("doc_id", F.lit(0)).alias("_key"), F.xxhash64("doc_id", "text").alias("_rid"))
    joined = keyed.join(spans.select(F.col("key").alias("_key"), F.col("rid").alias("_rid"), F.col("spans").alias("_spans")), ["_key", "_rid"], "left")
    joined = joined.select(*docs.columns, "_spans")
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def rows(batches):
        for batch in batches:
            texts, counts, gone, digests = [], [], [], []
            for text, spans_ in zip(batch.column(at).to_pylist(), batch.column(len(batch.columns) - 1)):
                words = (text or "").encode().split()
                if spans_.is_valid and len(spans_):
                    keep = np.ones(len(words), bool)
                    for x in spans_.as_py():
                        keep[x["from"] : x["to"]] = False
                    kept = [w for w, k in zip(words, keep.tolist()) if k]
                    raw = b" ".join(kept)
                    text = raw.decode()
                else:
                    kept, raw = words, b" ".join(words)
                texts.append(text), counts.append(len(words)), gone.append(len(words) - len(kept))
                digests.append(hashlib.sha256(raw).hexdigest())
            cols = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return joined.mapInArrow(rows, schema)


def op8_substrings(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
