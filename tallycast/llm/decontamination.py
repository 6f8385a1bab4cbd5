"""Benchmark decontamination: CGK walks and bit sampling find windows, edit distance decides."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import PUNCTUATION, Words, blocks, column, mix

#: Words below which an item has tables of its own.
SHORT = 12
#: Words of a part of an item; see ``parts_of``.
PART = 6


@dataclass(frozen=True)
class Sampling:
    """Walks, samples of each walk, places of each sample.

    A walk reads the words from a start on and stays on a word or goes to the
    next by a random bit of (word, step): the CGK embedding, under which few
    edits change few places. Each sample of places is one hash table: two
    places among the first ``near`` steps, the others anywhere in the reach of
    a part of the item. One table agrees on a part with a fifth of its words
    edited with a chance of about 0.1, so 36 tables find about 0.95 of such
    parts, and a longer item has several of them; the tests measure recall by
    length.
    """

    walks: int = 4
    samples: int = 9
    places: int = 4
    near: int = 14
    seed: int = 9

    def tables(self) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """For each walk its samples: near steps, and later places as shares of the reach."""
        r = np.random.default_rng(self.seed)
        draw = lambda: (np.sort(r.choice(self.near, 2, replace=False)), np.sort(r.random(self.places - 2)))
        return [[draw() for _ in range(self.samples)] for _ in range(self.walks)]

    def flips(self) -> np.ndarray:
        return np.random.default_rng(self.seed + 1).integers(0, 2**64, (self.walks, 1), np.uint64) | np.uint64(1)


def _step_bits(h: np.ndarray, flip: np.ndarray) -> np.ndarray:
    """64 random bits of each word for one walk."""
    return mix(h * flip)


def normalised(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(column(texts))


def least_edits(item: list, text: list, from_start: bool = False) -> tuple[int, int]:
    """(distance, end) of the stretch of ``text`` nearest to ``item``; the earliest end wins. Columns are bits of an integer.

    With ``from_start`` only stretches from the first word on count.
    """
    m = len(item)
    places: dict = {}
    for i, x in enumerate(item):
        places[x] = places.get(x, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, t in enumerate(text, 1):
        same = places.get(t, 0)
        x = same | minus
        d = (((same & plus) + plus) ^ plus) | same
        up, down = minus | (full & ~(d | plus)), d & plus
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1 | from_start) & full, (down << 1) & full
        plus, minus = down | (full & ~(x | up)), up & x
        if score < best:
            best, end = score, j
    return best, end


def edit_distance(item: list, text: list, most: int) -> tuple[int, int, int]:
    """(distance, start, end) of the stretch of ``text`` that needs the fewest edits to become ``item``.

    The earliest end wins a tie, then the latest start. A distance above
    ``most`` is given as most + 1. The start is where the reversed item ends
    in the reversed text.
    """
    distance, end = least_edits(item, text)
    if distance > most:
        return most + 1, 0, 0
    back = text[max(0, end - len(item) - distance) : end][::-1]
    return distance, end - least_edits(item[::-1], back, True)[1], end


class Items:
    """Benchmark items of one bounded block, with their tables of sampled keys."""

    def __init__(self, ids: list, texts: list[str], share: float, sampling: Sampling):
        self.ids, self.sampling, self.words = [], sampling, []
        hashes = []
        for lo, hi, data, offsets in blocks(normalised(pa.array(texts, pa.large_string()))):
            w = Words(data, offsets, PUNCTUATION)
            h = w.hashes()
            for i in range(lo, hi):
                own = h[w.bounds[i - lo] : w.bounds[i - lo + 1]]
                if len(own):
                    self.ids.append(ids[i])
                    hashes.append(own)
        self.words = [own.tolist() for own in hashes]
        self.sizes = np.array([len(x) for x in hashes], np.int64)
        h = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        own = _join(np.repeat(np.arange(len(hashes), dtype=np.uint64), self.sizes), h)
        self.shift = _shift(len(own))
        #: slots of (item, word): a word of the item is always in, one of 64 others as well
        self.known = np.zeros(1 << (64 - int(self.shift)), bool)
        self.known[(own >> self.shift).astype(np.int64)] = True
        self.most = np.floor(share * self.sizes + 1e-9).astype(np.int64)
        #: parts of the items: item, words before the part
        self.owner, self.offset = [], []
        lengths = []
        for i, n in enumerate(self.sizes.tolist()):
            cuts = parts_of(n)
            self.owner += [i] * (len(cuts) - 1)
            self.offset += cuts[:-1]
            lengths += np.diff(cuts).tolist()
        of_reach: dict[int, list[int]] = {}
        for part, n in enumerate(lengths):
            if self.sizes[self.owner[part]] >= SHORT:
                of_reach.setdefault(self.reach(n), []).append(part)
        #: for each walk its tables: (near steps, tables of the parts by reach)
        self.walks: list[list[tuple[np.ndarray, list[Table]]]] = []
        self.room = max([self.reach(n) for n in lengths], default=0) + sampling.near + 1
        ends = np.cumsum(self.sizes)
        for samples, flip in zip(sampling.tables(), sampling.flips()):
            self.walks.append([(near, []) for near, _ in samples])
            walk = Walk(h, flip, self.room)
            for reach, members in sorted(of_reach.items()):
                owners = np.array(self.owner)[members]
                starts = (ends - self.sizes)[owners] + np.array(self.offset)[members]
                for (near, later), (_, parts) in zip(samples, self.walks[-1]):
                    after = sampling.near + (later * max(1, reach - sampling.near)).astype(np.int64)
                    parts.append(Table(walk, starts, ends[owners], near, after, np.array(members)))
        self._short(hashes)
        self.owner, self.offset = np.array(self.owner, np.int64), np.array(self.offset, np.int64)

    def _short(self, hashes: list[np.ndarray]) -> None:
        """Tables of the items below ``SHORT`` words, by their length: their walks are sampled below as many steps, which stay inside."""
        sampling = self.sampling
        for n in sorted({x for x in self.sizes.tolist() if x < SHORT}):
            items = np.flatnonzero(self.sizes == n)
            members = np.searchsorted(self.owner, items)  # a short item is one part
            h = np.concatenate([hashes[i] for i in items])
            starts = np.arange(len(members)) * n
            r = np.random.default_rng(sampling.seed + n)
            for walk, flip in zip(self.walks, sampling.flips()):
                for _ in range(sampling.samples):
                    steps = np.sort(r.integers(0, n, sampling.places))
                    walk.append((steps[:2], [Table(Walk(h, flip, self.room), starts, starts + n, steps[:2], steps[2:], members)]))

    @staticmethod
    def reach(n: int) -> int:
        """Steps that a walk over ``n`` words is sampled in: the largest power of two below 1.5 n, which it seldom leaves."""
        return max(2, 1 << int(np.log2(max(2, 1.5 * n))))


def parts_of(n: int) -> list[int]:
    """Bounds of the even parts, of ``PART`` words or a few more, that an item of ``n`` words is looked up by.

    Some part has no greater share of its words edited than the whole, and
    walks over a part do not drift far: a long item is found by any of its
    parts, and compared whole.
    """
    many = max(1, n // PART)
    return [i * n // many for i in range(many + 1)]


class Walk:
    """CGK walk over the words of a block. Past the block it stands still; users compare places with the ends of texts."""

    def __init__(self, h: np.ndarray, flip: np.ndarray, room: int):
        self.h = np.concatenate([h, np.zeros(room, np.uint64)])
        self.bits = _step_bits(self.h, flip)
        self.bits[len(h) :] = 0

    def go(self, at: np.ndarray, first: int, last: int) -> np.ndarray:
        """Places after the steps from ``first`` to before ``last``."""
        for step in range(first, last):
            at = at + ((self.bits[at] >> np.uint64(step & 63)) & np.uint64(1)).astype(np.int64)
        return at


def _shift(n: int) -> np.uint64:
    """Shift of a hash to some 64 slots for each of ``n`` entries: few others pass, and the table stays small."""
    return np.uint64(64 - int(np.clip(np.ceil(np.log2(64 * max(1, n))), 10, 22)))


def _join(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (key * np.uint64(0xD1342543DE82EF95) + word) * np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Sampled keys of the parts of one reach: a filter for the near places, sorted keys for all others."""

    def __init__(self, walk: Walk, starts: np.ndarray, ends: np.ndarray, near: np.ndarray, after: np.ndarray, members: np.ndarray):
        self.near, self.after = near, after
        at = walk.go(starts, 0, int(near[0]))
        key = walk.h[at]
        at = walk.go(at, int(near[0]), int(near[1]))
        keys, last = [_join(key, walk.h[at])], int(near[1])
        for step in after.tolist():
            at = walk.go(at, last, step)
            keys.append(_join(keys[-1], walk.h[at]))
            last = step
        ok = at < ends
        self.keys = [np.unique(k[ok]) for k in keys]
        self.shift = _shift(int(ok.sum()))
        self.filter = np.zeros(1 << (64 - int(self.shift)), bool)
        self.filter[(self.keys[0] >> self.shift).astype(np.int64)] = True
        order = np.argsort(keys[-1][ok], kind="stable")
        self.parts, all_keys = members[ok][order], keys[-1][ok][order]
        self.first, self.end = np.searchsorted(all_keys, self.keys[-1]), np.searchsorted(all_keys, self.keys[-1], "right")

    def search(self, walk: Walk, key: np.ndarray, places: np.ndarray, ends: np.ndarray):
        """Starts and parts, of starts whose walks have ``key`` after the near places and stand at ``places`` then."""
        live = np.flatnonzero(self.filter[(key >> self.shift).astype(np.int64)])
        at, key, last = places[live], key[live], int(self.near[1])
        for step, known in zip([last, *self.after.tolist()], self.keys):
            if not len(live) or not len(known):
                return live[:0], self.parts[:0]
            if step > last:
                at = walk.go(at, last, step)
            if known is not self.keys[0]:
                key = _join(key, walk.h[at])
            last = step
            found = np.minimum(np.searchsorted(known, key), len(known) - 1)
            same = (known[found] == key) & (at < ends[live])
            live, at, key, found = live[same], at[same], key[same], found[same]
        many = self.end[found] - self.first[found]
        return np.repeat(live, many), self.parts[_ranges(self.first[found], many)]


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of ``many[0]`` numbers, then those from first[1] on."""
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())


def candidates(items: Items, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and parts of windows that share a sampled key with a part of an item.

    All starts walk the near steps together; the few whose words pass the
    filters of a table go on alone.
    """
    n = len(h)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if not n or not len(items.sizes):
        return found[0]
    ends = np.repeat(bounds[1:], np.diff(bounds))
    for tables, flip in zip(items.walks, items.sampling.flips()):
        walk = Walk(h, flip, items.room)
        need = {int(x) for near, _ in tables for x in near}
        at = np.arange(n)
        places: dict[int, np.ndarray] = {}
        words: dict[int, np.ndarray] = {}
        for step in range(max(need) + 1):
            if step in need:
                places[step], words[step] = at, walk.h[at]
            at = walk.go(at, step, step + 1)
        for near, parts in tables:
            key = _join(words[int(near[0])], words[int(near[1])])
            for table in parts:
                found.append(table.search(walk, key, places[int(near[1])], ends))
    return tuple(np.concatenate(x) for x in zip(*found))


def windows_of(items: Items, w: Words, h: np.ndarray):
    """(text, item, first word, end word) of the windows to compare: hits of one stretch are one window."""
    at, part = candidates(items, h, w.bounds)
    doc, item = np.searchsorted(w.bounds, at, "right") - 1, items.owner[part]
    # where the whole item would start, if nothing before the part were edited; a text's first word may come later
    room = int(items.sizes.max(initial=0))
    span = len(h) + room + 1
    hits = np.unique((doc * len(items.sizes) + item) * span + at - items.offset[part] + room)
    both, start = hits // span, hits % span - room
    item = both % max(1, len(items.sizes))
    near = items.most[item] + 2
    new = np.ones(len(hits), bool)
    new[1:] = (both[1:] != both[:-1]) | (np.diff(start) > near[1:])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hits))[: len(first)] - 1
    both, item = both[first], item[first]
    doc = both // max(1, len(items.sizes))
    lo = np.maximum(w.bounds[doc], start[first] - near[first])
    hi = np.minimum(w.bounds[doc + 1], start[last] + items.sizes[item] + near[first])
    # enough words of the item in it
    keep = np.zeros(len(first), bool)
    for k in range(0, len(first), 10_000):
        part = slice(k, k + 10_000)
        many = hi[part] - lo[part]
        words = _join(np.repeat(item[part].astype(np.uint64), many), h[_ranges(lo[part], many)])
        sums = np.concatenate([[0], np.cumsum(items.known[(words >> items.shift).astype(np.int64)])])
        ends = np.cumsum(many)
        keep[part] = sums[ends] - sums[ends - many] >= (items.sizes - items.most)[item[part]]
    return zip(*(x[keep].tolist() for x in (doc, item, lo, hi)))


def leaks_of_block(items: Items, w: Words, h: np.ndarray):
    """(text, item, distance, first word, end word): the best window of each text and item within the bound."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for doc, i, lo, hi in windows_of(items, w, h):
        if best.get((doc, i), (1,))[0] == 0:
            continue
        most = int(items.most[i])
        distance, a, b = edit_distance(items.words[i], h[lo:hi].tolist(), most)
        if distance <= most and distance < best.get((doc, i), (most + 1,))[0]:
            first = int(w.bounds[doc])
            best[(doc, i)] = (distance, lo + a - first, lo + b - first)
    return [(doc, i, *v) for (doc, i), v in sorted(best.items())]


def item_blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """Benchmark rows in blocks of about ``block_bytes``, chosen by the hash of the text; one block for all that fits."""
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("b")).first()["b"]
    n = max(1, -(-size // block_bytes))
    return [rows.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == k) for k in range(n)]


def leaks(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.2, sampling: Sampling | None = None, block_bytes: int = 1 << 20
) -> DataFrame:
    """(doc_id, item_id, distance, item_words, first_word, end_word) of items that documents hold.

    Words are lower-cased runs of letters and digits. An item is held if some
    stretch of the text becomes it with edits of at most ``share`` of its words
    (inserted, deleted or replaced); the row has one of the best such stretches
    that were found. Items without words are in no document, nor is anything in
    a null text. Repeated rows are searched each. The benchmark is taken in
    blocks of at most about ``block_bytes``, each sent to the tasks and run
    against all documents; documents are not shuffled.
    """
    out = None
    for block in item_blocks(benchmark, block_bytes):
        got = block.toPandas().sort_values(["item_id", "text"])
        items = Items(got["item_id"].tolist(), got["text"].tolist(), share, sampling or Sampling())
        found = _search(docs, items)
        out = found if out is None else out.unionByName(found)
    return out


def _search(docs: DataFrame, items: Items) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for lo, _, data, offsets in blocks(normalised(batch.column(1))):
                w = Words(data, offsets, PUNCTUATION)
                hits = leaks_of_block(items, w, w.hashes())
                ids = [batch.column(0)[lo + d].as_py() for d, *_ in hits]
                cols = [ids, [items.ids[i] for _, i, *_ in hits], [h[2] for h in hits], [int(items.sizes[h[1]]) for h in hits], [h[3] for h in hits], [h[4] for h in hits]]
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "item_id", "distance", "item_words", "first_word", "end_word"]
                )

    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id long, item_id long, distance int, item_words int, first_word int, end_word int"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.2, sampling: Sampling | None = None, block_bytes: int = 1 << 20) -> DataFrame:
    """Documents that hold no item; all columns, nothing shuffled. See ``leaks``."""
    at = docs.columns.index("text")
    for block in item_blocks(benchmark, block_bytes):
        got = block.toPandas().sort_values(["item_id", "text"])
        items = Items(got["item_id"].tolist(), got["text"].tolist(), share, sampling or Sampling())

        def rows(batches, items=items):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, _, data, offsets in blocks(normalised(batch.column(at))):
                    w = Words(data, offsets, PUNCTUATION)
                    for d, *_ in leaks_of_block(items, w, w.hashes()):
                        keep[lo + d] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(rows, T.StructType(docs.schema.fields))
    return docs


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
