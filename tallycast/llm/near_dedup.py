"""Near-duplicate classes by order MinHash, verified by banded alignment."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, write_out
from .arrays import Words, blocks, column, mix, powers, window_hashes
from .components import components

#: Texts with at most so many runs get bands of two runs as well.
SHORT = 20


def text_hashes(w: Words, h: np.ndarray) -> np.ndarray:
    """A hash of all words of each text of a block; 0 for a text without words."""
    p, inv = powers(len(h) + 1)
    q = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[: len(h)], out=q[1:])
    return mix((q[w.bounds[1:]] - q[w.bounds[:-1]]) * inv[w.bounds[:-1]])


def shingles(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, bounds) of the k-word runs of each text of a block; a shorter text is one run."""
    g, valid = window_hashes(h, k, w.left())
    short = (w.counts > 0) & (w.counts < k)
    if short.any():
        at = w.bounds[:-1][short]
        valid[at], g[at] = True, text_hashes(w, h)[short]
    n_valid = np.concatenate([[0], np.cumsum(valid)])
    return g[valid], n_valid[w.bounds]


def labelled(s: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Runs with their occurrence number in their text mixed in, so that repeats are different items."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.argsort(s, kind="stable")  # equal runs stay in the order of their places, so those of a text are together
    new = np.ones(len(s), bool)
    new[1:] = (s[order[1:]] != s[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    at = np.flatnonzero(new)
    number = np.arange(len(s)) - np.repeat(at, np.diff(np.concatenate([at, [len(s)]])))
    out = np.empty_like(s)
    out[order] = mix(s[order] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def least_places(rank: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` least values of each row, in the order of the row."""
    n = rank.shape[1]
    if n == k:
        return np.tile(np.arange(n), (len(rank), 1))
    most = np.partition(rank, k - 1, axis=1)[:, k - 1 : k].copy()
    at = np.flatnonzero(rank <= most)
    if len(at) == k * len(rank):
        return at.reshape(-1, k) % n
    return np.sort(np.argpartition(rank, k - 1, axis=1)[:, :k], axis=1)  # equal values at the bound


class OrderSketch:
    """Order MinHash: for each of ``bands`` random orders, the ``rows`` least labelled runs, kept in the order of the text.

    With similarity s a band agrees with a chance of about s**rows; 24 bands of
    6 find a pair of similarity 0.8 with a chance above 0.999. Short texts,
    whose least runs are nearly all of them, also get bands of two.
    """

    def __init__(self, bands: int = 24, rows: int = 6, seed: int = 5):
        r = np.random.default_rng(seed)
        self.rows = rows
        self.flip = r.integers(0, 2**64, (bands, 1), np.uint64)
        self.scale = r.integers(0, 2**64, (bands, 1), np.uint64) | np.uint64(1)
        self.band = {k: mix(np.arange(bands, dtype=np.uint64) + np.uint64(1000 * k)) for k in (rows, 2)}
        self.order = np.random.default_rng(seed + 1).integers(0, 2**64, max(rows, 2), np.uint64) | np.uint64(1)

    def keys(self, items: np.ndarray) -> np.ndarray:
        """Band keys of one text."""
        n, out = len(items), []
        if n < 2:
            return np.zeros(0, np.uint64)
        rank = items ^ self.flip
        rank *= self.scale
        for rows in (self.rows, 2):
            if n < rows or (rows == 2 and n > SHORT):
                continue
            least = least_places(rank, rows)
            out.append(mix((mix(items[least]) * self.order[:rows]).sum(1, dtype=np.uint64) + self.band[rows]))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketches(docs: DataFrame, k: int, sketch: OrderSketch) -> DataFrame:
    """(doc_id, w1, w2, n, bands): two hashes of all words, runs, band keys."""
    names = ["doc_id", "w1", "w2", "n", "bands"]

    def rows(batches):
        for batch in batches:
            for b, e, data, offsets in blocks(column(batch.column(1))):
                w = Words(data, offsets)
                h = w.hashes()
                s, bounds = shingles(w, h, k)
                items = labelled(s, bounds)
                whole = [text_hashes(w, v) for v in (h, mix(h + np.uint64(11)))]
                keys = [sketch.keys(items[bounds[i] : bounds[i + 1]]) for i in range(e - b)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys).view(np.int64)))
                cols = [batch.column(0).slice(b, e - b), pa.array(whole[0].view(np.int64)), pa.array(whole[1].view(np.int64)), pa.array(np.diff(bounds)), bands]
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, w1 long, w2 long, n long, bands array<long>")


def matches(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Items matched by the best alignment of two lists where that is ``need`` or more, else -1.

    Such an alignment leaves at most len a + len b - 2 need items unmatched, so
    no match lies farther than that from the diagonal. A row of the table is one
    integer whose bits are the columns of that band; it moves by a column a row.
    """
    if min(len(a), len(b)) < need:
        return -1
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    differ = np.flatnonzero(a[len(a) - short + head :][::-1] != b[len(b) - short + head :][::-1])
    tail = int(differ[0]) if len(differ) else short - head
    band = len(a) + len(b) - 2 * need
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    found = head + tail
    if len(a) and len(b) and found + min(len(a), len(b)) >= need:
        common = np.isin(a, b)
        if found + common.sum() < need:
            return -1
        places: dict[int, list[int]] = {}
        held = np.isin(b, a)
        for j, x in zip(np.flatnonzero(held).tolist(), b[held].tolist()):
            places.setdefault(x, []).append(j)
        width = 2 * band + 1
        full = (1 << width) - 1
        v, base = full, -band  # bit k is column base + k; a bit is 0 where the column adds a match
        for i in np.flatnonzero(common).tolist():
            step = i - band - base
            if step:
                gone = min(step, width)
                found += gone - (v & ((1 << gone) - 1)).bit_count()
                v = (v >> gone) | (full >> (width - gone) << (width - gone))
                base += step
            m = 0
            for j in places[int(a[i])]:
                if 0 <= j - base < width:
                    m |= 1 << (j - base)
            u = v & m
            v = ((v + u) | (v ^ u)) & full
        found += width - v.bit_count()
    return found if found >= need else -1


def least_matches(total: int, least: float) -> int:
    """Matches from which on lists of ``total`` items together have the similarity ``least``."""
    return int(np.ceil(least * total / (1 + least) - 1e-9))


def aligned(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """m / (len a + len b - m) for the m items matched by the best alignment; 0 below ``least``."""
    total = len(a) + len(b)
    m = matches(a, b, least_matches(total, least))
    return 0.0 if m < 0 else m / (total - m) if total else 1.0


#: So many texts of a bucket may lead it at once in the first round, twice as many in each later one.
LEADS = 32
_REORDERED = np.uint64(1)


def unshared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items of ``a`` that ``b`` lacks and items of ``b`` that ``a`` lacks, sorted; neither has an item twice. Sorted lists are merged."""
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")
    both = both[order]
    edge = np.ones(len(both) + 1, bool)
    edge[1:-1] = both[1:] != both[:-1]
    alone = edge[1:] & edge[:-1]
    own = order < len(a)
    return both[alone & own], both[alone & ~own]


def difference(text: tuple[np.ndarray, np.ndarray], lead: tuple[np.ndarray, np.ndarray], similarity: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(additions, missing, order marks) of a text, as (runs, labelled runs), against a lead.

    Let d be the number of runs that an alignment leaves unmatched; it is a
    metric, and texts x and y are linked if d(x, y) <= share (|x| + |y|) with
    share = (1 - least) / (1 + least). A text y of small difference which the
    lead does not link has its runs in another order; such texts have a mark of
    their own. A text x that the lead links can be linked to y only if d(y, lead)
    is at most d(x, lead) + share (|x| + |y|): both have marks for cells of that
    distance. The last bit of a mark says that a text makes a bucket; one
    without such a text is not needed.
    """
    items, other = text[1], lead[1]
    more, missing = unshared(items, other)
    more, missing = mix(more), mix(missing ^ np.uint64(0x5851F42D4C957F2D))
    total, share = len(items) + len(other), (1 - least) / (1 + least)
    cell, marks = max(1.0, share * len(other) / 4), np.zeros(0, np.uint64)
    if similarity >= least:
        distance = total - 2 * round(similarity * total / (1 + similarity))
        first = int(share * (1 + least) * len(other) / cell)
        last = int((distance + share * len(items) * (1 + 1 / least)) / cell)
        marks = mix(np.arange(first, max(first, last + 1)).astype(np.uint64) + np.uint64(77)) & ~np.uint64(1)
    elif len(more) + len(missing) <= share * total + 1e-9:
        farthest = share * (2 * min(len(items), len(other)) / least + total)
        m = matches(text[0], lead[0], max(0, int(np.ceil((total - farthest) / 2 - 1e-9))))
        at = np.full(int(m >= 0), int((total - 2 * m) / cell), np.uint64)
        marks = np.concatenate([np.full(1, _REORDERED), mix(at + np.uint64(77))]) | np.uint64(1)
    return np.sort(more), np.sort(missing), marks


def difference_marks(more: np.ndarray, missing: np.ndarray, own: int, other: int, common: np.ndarray, least: float) -> np.ndarray:
    """Marks of which a text shares one with any text it is linked to, unless the lead links both or their order differs.

    ``own`` and ``other`` are the sizes of the text and the lead, ``common``
    are items that many texts differ in from this lead. Let x and y be linked.

    - If the difference of y is larger than share (own + other), x and y share
      more than (size of x's difference + share (|lead| - |x|)) / 2 of their
      items; y shares at least its size less share (|x| + |y|). In any common
      order the first (size - shared + 1) items of both meet (prefix filter).
      The order puts common items last, and additions before what is missing.
      The longer prefix of a y is needed only to meet an x of small difference,
      whose prefix makes the bucket.
    - If nothing is common, and x and y share no addition, all they share is
      missing from both, and all additions count against the bound. Then x
      misses more than it adds, so only such texts need marks of missing items,
      or a y that meets such a text.
    """
    mo, mi, size, share = len(more), len(missing), len(more) + len(missing), (1 - least) / (1 + least)
    most = int(share * own * (1 + 1 / least) + 1e-9)
    small = size <= share * (own + other) + 1e-9
    shared = int(np.floor((size + share * (other - own)) / 2 - 1e-9)) + 1
    makes = max(0, size - shared + 1)
    joins = makes if small else max(makes, size - max(1, size - most) + 1)
    if len(common):
        rare = [x[~np.isin(x, common)] for x in (more, missing)]
        held = np.sort(np.concatenate([x[np.isin(x, common)] for x in (more, missing)]))
        order = np.concatenate([*rare, held])
        parts = [order[:makes]], [order[makes:joins]]
    else:
        parts = [more[:makes]], [more[makes:joins]]
        if mo <= most:
            alone = max(0, mi - shared + 1) if mi > mo else 0
            parts[0].append(missing[:alone])
            if not small:
                beyond = int(np.ceil(size - share * (own + other) - 1e-9))  # a text that misses more than it adds is shorter than the lead
                parts[1].append(missing[alone : max(alone, mi - max(1, beyond) + 1)])
    return np.concatenate([np.concatenate(parts[0]) | np.uint64(1), np.concatenate(parts[1]) & ~np.uint64(1)])


def _joined_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (tid, lead, ...) with both texts; a text is shuffled for each pair."""
    own, other = (docs.select(F.col("doc_id").alias(c), F.col("text").alias(f"t{c}")) for c in ("tid", "lead"))
    return pairs.join(own, "tid").join(other, "lead").select(*pairs.columns, "ttid", "tlead")


def _runs(side: pa.Array, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(runs, sorted labelled runs) of each text."""
    out = []
    for _, _, data, offsets in blocks(side):
        w = Words(data, offsets)
        s, bounds = shingles(w, w.hashes(), k)
        items = labelled(s, bounds)
        out += [(s[x:y], np.sort(items[x:y])) for x, y in zip(bounds[:-1], bounds[1:])]
    return out


def _paired_runs(texts: pa.Array, leads: pa.Array, k: int) -> tuple[list, list]:
    """The runs of both sides of pairs; a lead has many texts, but its runs are made once."""
    told = column(leads).dictionary_encode()
    made = _runs(told.dictionary, k)
    return _runs(column(texts), k), [made[i] for i in told.indices.to_pylist()]


def _lists(arrays: list) -> pa.Array:
    return pa.array([x if x is None else x.view(np.int64) for x in arrays], pa.list_(pa.int64()))


_COMPARED = "tid long, lead long, similarity double, more array<long>, missing array<long>, marks array<long>, own long, other long"


def _compared(pairs: DataFrame, docs: DataFrame, k: int, least: float) -> DataFrame:
    """Similarities of pairs of texts, and how they differ where ``deal`` asks for it."""
    names = [c.split()[0] for c in _COMPARED.split(", ")]

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                own, other = _paired_runs(part.column(3), part.column(4), k)
                sims = [aligned(x[0], y[0], least) for x, y in zip(own, other)]
                diffs = [difference(x, y, sim, least) if d else (None, None, None) for d, sim, x, y in zip(part.column(2).to_pylist(), sims, own, other)]
                sizes = [pa.array([len(x[0]) for x in side], pa.int64()) for side in (own, other)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sims, pa.float64()), *(_lists(list(c)) for c in zip(*diffs)), *sizes], names)

    return _joined_texts(pairs.select("tid", "lead", "deal"), docs).mapInArrow(rows, _COMPARED)


def _arrays(lists: pa.Array) -> list[np.ndarray]:
    """The rows of a column of lists; null counts as empty."""
    values, bounds = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
    return [values[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]


def _marked(diffs: DataFrame, least: float) -> DataFrame:
    """(tid, lead, marks, n) of compared texts and the number of texts of their lead. Common are items that a quarter of a lead's texts, and eight, differ in within some batch; that decides an order only."""

    def often(batches):
        for batch in batches:
            leads = batch.column(0).to_numpy()
            items = [np.concatenate(x) for x in zip(_arrays(batch.column(1)), _arrays(batch.column(2)))]
            out = [[], []]
            for lead in np.unique(leads):
                rows = np.flatnonzero(leads == lead)
                item, n = np.unique(np.concatenate([items[i] for i in rows]), return_counts=True)
                item = item[(n >= 8) & (4 * n > len(rows))]
                out[0].append(np.full(len(item), lead))
                out[1].append(item.view(np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], ["lead", "item"])

    def rows(batches):
        for batch in batches:
            get = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            parts = zip(*(_arrays(get[c]) for c in ("more", "missing", "marks", "common")), get["own"].to_pylist(), get["other"].to_pylist())
            marks = [np.concatenate([order, difference_marks(more, missing, own, other, common, least)]) for more, missing, order, common, own, other in parts]
            yield pa.RecordBatch.from_arrays([get["tid"], get["lead"], _lists(marks), get["n"]], ["tid", "lead", "marks", "n"])

    none = F.array().cast("array<long>")
    common = diffs.select("lead", "more", "missing").mapInArrow(often, "lead long, item long")
    common = common.groupBy("lead").agg(F.collect_set("item").alias("common"))
    # cells of distances are for leads that have texts of another order
    turned = F.max(F.exists("marks", lambda m: m.bitwiseAND(1) == 1)).alias("turned")
    told = diffs.join(common, "lead", "left").join(diffs.groupBy("lead").agg(turned, F.count("*").alias("n")), "lead").select(
        "tid", "lead", "more", "missing", F.when(F.col("turned"), F.col("marks")).otherwise(none).alias("marks"), F.coalesce("common", none).alias("common"), "own", "other", "n"
    )
    return told.mapInArrow(rows, "tid long, lead long, marks array<long>, n long")


#: Texts of a lead for each part that its marks are dealt to.
PART = 512


def _met(marked: DataFrame) -> DataFrame:
    """(tid, lead, mark) of those marks (tid, lead, marks, n) that another text of the lead has too; n is the number of its texts.

    Most marks are of one text only and are of no use, so they never become
    rows. What meets within a batch is told at once, and one of each such mark
    goes on without its text. The others travel as lists by part of the lead:
    a mark comes at most once from each batch, however many texts share it.
    """

    def split(batches):
        for batch in batches:
            get = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            tid, lead, n = (get[c].to_numpy() for c in ("tid", "lead", "n"))
            lists = _arrays(get["marks"])
            owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            if not len(owner):
                continue
            mark = np.concatenate(lists)
            order = np.lexsort((mark, lead[owner]))
            owner, mark = owner[order], mark[order]
            tid, lead, n, key = tid[owner], lead[owner], n[owner], mark >> np.uint64(1)
            at = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (lead[1:] != lead[:-1])]))
            count = np.diff(np.append(at, len(key)))
            many, first = np.repeat(count > 1, count), at[count > 1]
            part = (key % (1 + n // PART).astype(np.uint64)).astype(np.int64)
            rows = np.concatenate([np.flatnonzero(many), np.flatnonzero(~many), first])
            kind = np.repeat([0, 1, 2], [many.sum(), (~many).sum(), len(first)])
            tid, lead, part, mark = np.where(kind < 2, tid[rows], 0), lead[rows], np.where(kind > 0, part[rows], -1), mark[rows]
            order = np.lexsort((part, tid, lead, kind))
            cols = [x[order] for x in (kind, tid, lead, part)]
            at = np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in cols], axis=0)]))
            kind, tid, lead, part = (x[at] for x in cols)
            marks = pa.ListArray.from_arrays(pa.array(np.append(at, len(mark)), pa.int32()), pa.array(mark[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(tid, pa.int64(), mask=kind == 2), pa.array(lead), pa.array(part), marks], ["tid", "lead", "part", "marks"])

    def shared(table):
        lists = _arrays(table.column("marks").combine_chunks())
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        told = table.column("tid").is_null().to_numpy()[owner]
        mark = np.concatenate(lists)
        _, key = np.unique(mark >> np.uint64(1), return_inverse=True)
        meets = (np.bincount(key, 1.0 + told) > 1)[key] & ~told
        take = pa.array(owner[meets])
        return pa.table({"tid": table.column("tid").take(take), "lead": table.column("lead").take(take), "mark": mark[meets].view(np.int64)})

    parts = write_out(marked.mapInArrow(split, "tid long, lead long, part long, marks array<long>"), "marks")
    here = parts.filter("part < 0").select("tid", "lead", F.explode("marks").alias("mark"))
    return here.unionByName(parts.filter("part >= 0").groupBy("lead", "part").applyInArrow(shared, "tid long, lead long, mark long"))


def _centres(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(lead, centre): of the texts of a lead the one that is nearest to what most of them hold.

    A group of copies is best dealt by its original, as what the lead itself has
    changed would be a mark of all others. Half of the runs (by their hashes) are
    looked at: a centre only decides who leads.
    """

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                diffs = []
                for x, y in zip(*_paired_runs(part.column(2), part.column(3), k)):
                    more, missing = unshared(x[1], y[1])
                    diff = mix(np.concatenate([more, missing ^ np.uint64(1)]))
                    diffs.append(diff[diff & np.uint64(1) == 0])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _lists(diffs)], ["tid", "lead", "items"])

    diffs = write_out(_joined_texts(pairs.select("tid", "lead"), docs).mapInArrow(rows, "tid long, lead long, items array<long>"), "differences")
    each = diffs.select("lead", "tid", F.explode("items").alias("item"))
    counts = each.groupBy("lead", "item").agg(F.count("*").alias("c")).join(diffs.groupBy("lead").agg(F.count("*").alias("n")), "lead")
    shared = each.join(counts.filter("2 * c > n").select("lead", "item"), ["lead", "item"]).groupBy("lead", "tid").agg(F.count("*").alias("common"))
    away = (F.size("items") - 2 * F.coalesce("common", F.lit(0))).alias("away")
    away = diffs.join(shared, ["lead", "tid"], "left").select("lead", away, "tid")
    away = away.unionByName(pairs.select("lead", F.lit(0).alias("away"), F.col("lead").alias("tid")).distinct())
    return away.groupBy("lead").agg(F.min(F.struct("away", "tid"))["tid"].alias("centre"))


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid"))


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(tid, root) after new links (a, b); only the roots they join are gone through again."""
    if roots is None:
        return components(links.distinct()).select(F.col("v").alias("tid"), "root")
    for c in ("a", "b"):
        known = roots.select(F.col("tid").alias(c), F.col("root").alias("to"))
        links = links.join(known, c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
    links = write_out(links.filter("a <> b").distinct(), "links")
    if not links.limit(1).count():
        return roots
    step = write_out(components(links), "steps")
    nodes = step.select(F.col("v").alias("tid")).join(roots, "tid", "left_anti").withColumn("root", F.col("tid"))
    moved = roots.unionByName(nodes).join(step.select(F.col("v").alias("root"), F.col("root").alias("to")), "root", "left")
    return write_out(moved.select("tid", F.coalesce("to", "root").alias("root")), "classes")


def _buckets_of(rows: DataFrame) -> DataFrame:
    """(bucket, others, makers, main) of buckets that are not done: texts outside the largest class, texts that make it, and that class."""
    sizes = rows.groupBy("bucket", "root").agg(F.count("*").alias("c"), F.count_if("makes").alias("makers"))
    out = sizes.groupBy("bucket").agg(F.sum("c").alias("n"), F.max(F.struct("c", "root")).alias("top"), F.sum("makers").alias("makers"))
    return out.select("bucket", (F.col("n") - F.col("top.c")).alias("others"), "makers", F.col("top.root").alias("main")).filter("others > 0 and makers > 0")


def near_classes(docs: DataFrame, k: int = 5, least: float = 0.8, sketch: OrderSketch | None = None, log: list | None = None) -> DataFrame:
    """(doc_id, class_id), a row for each document; class_id is the least doc_id of its class.

    Texts with the same words are copies and become one text first. Two texts
    are linked if their runs of ``k`` words align with at least ``least`` of
    them shared; classes are what links connect. Texts that share a band meet
    in its bucket. In each round a bucket whose texts are in one class is done.
    Where few texts are outside its largest class, or few make it (``LEADS``,
    doubled in each round), those are compared with all texts of other classes, which ends
    the bucket. Any other
    bucket has one lead: at first the centre of what its texts meet anywhere
    (the original of a group of copies, also where it is not in the bucket),
    later that of its texts that meets most others. All its texts are compared with the
    lead and dealt anew by marks of how they differ from it: two texts that are
    linked but not in one class yet share a mark (see ``difference_marks``). So
    no link between texts of a bucket is given up and no bucket is cut or
    dropped. A large class of copies costs two pairs a text, and up to ``LEADS``
    more where others are among them. Rounds are logarithmic in the largest
    bucket, as at last its texts may all lead; only texts that differ from their
    lead in the same ways, but are not linked, come to that. ``log`` takes (texts in buckets, pairs) of
    each round.

    Rows that share a doc_id are in one class. Rows without an id take no part
    and get a null class. Texts without words are copies of one another.
    """
    spark = docs.sparkSession
    have = docs.select("doc_id", "text").filter("doc_id is not null")
    sketched = write_out(sketches(have, k, sketch or OrderSketch()), "sketches")
    copies = write_out(sketched.groupBy("w1", "w2").agg(F.min("doc_id").alias("tid")), "copies")
    first = F.when(F.col("doc_id") == F.col("tid"), F.col("bands")).alias("bands")
    member = write_out(sketched.join(copies, ["w1", "w2"]).select("doc_id", "tid", first), "members")
    # a document whose id stands for another text as well links both
    twice = sketched.groupBy("doc_id").agg(F.min("w1").alias("x"), F.max("w1").alias("y")).filter("x <> y").select("doc_id")
    extra = member.filter("doc_id <> tid").join(twice, "doc_id", "left_semi").select(F.col("tid").alias("a"), F.col("doc_id").alias("b"))
    # most bands are of one text only, so they go before repeated rows are looked for and texts are counted
    texts = member.select("tid", F.explode("bands").alias("bucket"))
    meet = write_out(texts.groupBy("bucket").agg(F.min("tid").alias("x"), F.max("tid").alias("y")).filter("x <> y").select("bucket"), "meet")
    texts = write_out(texts.join(meet, "bucket", "left_semi").distinct(), "met")
    sizes = write_out(texts.groupBy("bucket").agg(F.count("*").alias("n")), "sizes")
    buckets = write_out(texts.join(sizes, "bucket"), "buckets")
    # texts that meet many others are the likeliest to be linked to them, so they lead
    weight = write_out(buckets.groupBy("tid").agg(F.sum("n").alias("weight")), "weights")
    have = write_out(have.join(weight.select(F.col("tid").alias("doc_id")), "doc_id", "left_semi"), "texts")
    buckets = buckets.select("bucket", "tid", F.lit(True).alias("makes")).join(weight, "tid").withColumn("root", F.col("tid"))
    compared, known, roots, most_leads = scratch_path(spark, "compared"), None, None, LEADS
    while True:
        state = write_out(_buckets_of(buckets), "state")
        rows = write_out(buckets.join(state, "bucket"), "rows")
        # a few texts, outside the largest class or those that make the bucket, lead; where two of them meet, one of them does
        alone = F.when(F.col("others") <= most_leads, F.col("root") != F.col("main")).otherwise(F.col("makes"))
        few = (F.col("others") <= most_leads) | (F.col("makers") <= most_leads)
        small = rows.filter(few).withColumn("leads", alone)
        # two texts meet in many buckets: a text gathers its leads over them, so that a pair is one row
        leads = small.filter("leads").groupBy("bucket").agg(F.collect_list(F.struct("tid", "root", "makes")).alias("by"))
        apart = lambda x: (x["root"] != F.col("root")) & (x["makes"] | F.col("makes")) & (~F.col("leads") | (x["tid"] < F.col("tid")))
        met = small.join(leads, "bucket").select("tid", F.filter("by", apart)["tid"].alias("by")).filter("size(by) > 0")
        met = met.groupBy("tid").agg(F.array_distinct(F.flatten(F.collect_list("by"))).alias("by")).select("tid", F.explode("by").alias("lead"))
        large = rows.filter(~few)
        if known is None:
            tops = rows.groupBy("bucket").agg(F.max(F.struct("weight", "tid")).alias("top"))
            mates = rows.join(tops, "bucket").groupBy("tid").agg(F.max("top").alias("top"))
            votes = large.join(mates, "tid").groupBy("bucket", "top").agg(F.count("*").alias("c"))
            first = write_out(votes.groupBy("bucket").agg(F.max(F.struct("c", "top"))["top"]["tid"].alias("lead")), "voted")
            voted = large.join(first, "bucket").filter("tid <> lead").select("tid", "lead").distinct()
            first = first.join(_centres(voted, have, k), "lead").select("bucket", F.col("centre").alias("lead"))
        else:
            first = large.groupBy("bucket").agg(F.max(F.struct("weight", "tid"))["tid"].alias("lead"))
        pairs = write_out(large.join(first, "bucket").filter("tid <> lead").select("bucket", "tid", "lead", "weight", "makes"), "pairs")
        todo = pairs.select("tid", "lead").distinct()
        if known is not None:  # known pairs are not aligned again, but still count below; marks hold for one direction
            todo = todo.join(known.filter("marks is not null").select("tid", "lead"), ["tid", "lead"], "left_anti")
            done = known.select("tid", "lead")
            met = met.join(done.unionByName(done.select(F.col("lead").alias("tid"), F.col("tid").alias("lead"))), ["tid", "lead"], "left_anti")
        asked = todo.withColumn("deal", F.lit(True)).unionByName(met.withColumn("deal", F.lit(False)))
        found = write_out(_compared(asked.groupBy("tid", "lead").agg(F.max("deal").alias("deal")), have, k, least), "found")
        found.write.mode("append").parquet(compared)
        known = spark.read.schema(found.schema).parquet(compared)
        if log is not None:
            log.append((rows.count(), found.count()))
        new = found.filter(F.col("similarity") >= least).select(F.least("tid", "lead").alias("a"), F.greatest("tid", "lead").alias("b"))
        roots = _joined(roots, new if roots is not None else new.unionByName(extra))
        if not pairs.limit(1).count():
            break
        most_leads *= 2
        mixed = _buckets_of(_with_roots(pairs, roots)).select("bucket")  # a lead has met all others
        again = write_out(pairs.join(mixed, "bucket", "left_semi").select("tid", "lead", "weight").distinct(), "again")
        differ = write_out(known.filter("marks is not null").join(again.select("tid", "lead"), ["tid", "lead"], "left_semi"), "differ")
        dealt = again.join(_met(_marked(differ, least)), ["tid", "lead"])
        dealt = dealt.select(F.xxhash64("lead", F.shiftright("mark", 1)).alias("bucket"), "tid", "weight", F.col("mark").bitwiseAND(1).cast("boolean").alias("makes"))
        dealt = write_out(dealt, "dealt")
        met_again = dealt.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("makes").alias("makers")).filter("n > 1 and makers > 0").select("bucket")
        buckets = write_out(_with_roots(dealt.join(met_again, "bucket", "left_semi"), roots), "buckets")
    classes = member.join(roots, "tid", "left").select("doc_id", F.coalesce("root", "tid").alias("class_id"))
    classes = classes.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return docs.select("doc_id").join(classes, "doc_id", "left")


def op5_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_classes(spark.read.parquet(f"{sf}/documents.parquet"))
