"""Near-duplicates and repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from fixtures import documents  # noqa: F401

from tallycast.llm import near_dedup
from tallycast.llm.components import components
from tallycast.llm.arrays import Words, blocks, column, mix, window_hashes
from tallycast.llm.near_dedup import OrderSketch, aligned, difference, difference_marks, labelled, near_classes
from tallycast.llm.substrings import without_repeats

R = random.Random(2)


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_banded_alignment():
    for _ in range(1500):
        a = [R.randint(0, R.choice([3, 50])) for _ in range(R.randint(0, 40))]
        b = list(a)
        for _ in range(R.randint(0, 5)):
            if b and R.random() < 0.5:
                b.pop(R.randrange(len(b)))
            else:
                b.insert(R.randint(0, len(b)), R.randint(0, 60))
        m = common(a, b)
        s = m / (len(a) + len(b) - m) if a or b else 1.0
        got = aligned(np.array(a, np.uint64), np.array(b, np.uint64), 0.8)
        assert (got >= 0.8) == (s >= 0.8 - 1e-12) and (s < 0.8 or abs(got - s) < 1e-9)


def test_linked_texts_share_a_mark():
    r = random.Random(3)
    items = lambda t: labelled(mix(np.array(t, np.uint64)), np.array([0, len(t)]))
    sim = lambda a, b: aligned(np.array(a, np.uint64), np.array(b, np.uint64), 0.8)
    linked = lambda a, b: sim(a, b) >= 0.8

    def changed(text, edits):
        t = list(text)
        for _ in range(edits):
            at, kind = r.randrange(len(t)), r.random()
            if kind < 0.3 and len(t) > 3:
                t.pop(at)
            elif kind < 0.6:
                t.insert(at, r.randint(0, 10**9))
            else:
                t[at] = r.randint(0, 10**9)
        at = r.randrange(len(t)) if r.random() < 0.15 else 0
        return t[at:] + t[:at]

    n = 0
    for _ in range(1500):
        lead = [r.randint(0, 10**9) for _ in range(r.randint(10, 60))]
        y = changed(lead, r.randint(0, len(lead)))
        x = changed(y, r.randint(0, max(1, len(y) // 6)))
        by_lead = [linked(t, lead) for t in (x, y)]
        if linked(x, y) and not all(by_lead):
            told = [difference((np.array(t, np.uint64), items(t)), (np.array(lead, np.uint64), items(lead)), sim(t, lead), 0.8) for t in (x, y)]
            often = [v for d in told for side in d[:2] for v in side.tolist()]
            few = np.array(R.sample(often, min(len(often), R.choice([0, 0, 3, 12]))), np.uint64)
            a, b = ({int(m) >> 1: int(m) & 1 for part in (d[2], difference_marks(*d[:2], len(t), len(lead), few, 0.8)) for m in part} for t, d in zip((x, y), told))
            assert any(a[m] or b[m] for m in a.keys() & b.keys())
            n += 1
    assert n > 500


def roots(edges, nodes):
    p = {n: n for n in nodes}

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        p[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    edges = [(R.randrange(60), R.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges * 2, "a long, b long")).collect()}
    assert got == roots(edges, nodes)


def runs(text):
    w = (text or "").encode().split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])


def classes(rows):
    have = [(i, runs(t)) for i, t in rows if i is not None]
    links = []
    for x in range(len(have)):
        for y in range(x):
            (i, a), (j, b) = have[x], have[y]
            if min(len(a), len(b)) < 0.8 * max(len(a), len(b)) or sum((Counter(a) & Counter(b)).values()) < 0.5 * len(a):
                continue
            m = common(a, b)
            if not a or m / (len(a) + len(b) - m) >= 0.8 - 1e-12:
                links.append((i, j))
    return roots(links, {i for i, _ in have})


def near_rows():
    words = [f"w{i}" for i in range(300)]
    rows = [(0, ""), (1, None), (2, "a b"), (3, "a  b"), (4, "a b c d e f g h"), (5, "a b c d e f g h i"), (6, "x y x y x y x y"), (None, "a b")]
    for _ in range(25):
        base = [R.choice(words) for _ in range(R.choice([8, 15, 40, 120, 400]))]
        for _ in range(R.randint(1, 6)):
            t = list(base)
            for _ in range(R.randint(0, max(1, len(t) // 40))):
                t[R.randrange(len(t))] = R.choice(words)
            rows.append((len(rows) + 10, " ".join(t)))
    return rows


def test_near_classes(documents):
    rows = near_rows()
    got = near_classes(documents(rows)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == classes(rows)
    assert [r["class_id"] for r in got if r["doc_id"] is None] == [None] and len(got) == len(rows)


def test_near_classes_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in near_classes(docs).collect()}
    assert got == classes([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_repeated_ids_and_empty(documents):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, "u v w x y z"), (2, text), (3, "u v w x y z"), (4, "other words stand here now")]
    got = {r["doc_id"]: r["class_id"] for r in near_classes(documents(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}
    assert near_classes(documents([])).collect() == []
    assert [tuple(r) for r in near_classes(documents([(7, "only one text")])).collect()] == [(7, 7)]


def test_recall_at_the_bound():
    sketch, hit, n = OrderSketch(), 0, 300
    r = np.random.default_rng(0)
    for _ in range(n):
        a = r.integers(0, 2**63, 180).astype(np.uint64)
        b = np.concatenate([a[:80], r.integers(0, 2**63, 20).astype(np.uint64), a[100:]])  # 160 of 200 shared
        hit += bool(set(sketch.keys(a).tolist()) & set(sketch.keys(b).tolist()))
    assert hit / n > 0.99


def brute_repeats(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        keep = [True] * len(w)
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j : j + window])] > 1:
                keep[j : j + window] = [False] * window
        kept = [x for x, k in zip(w, keep) if k]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


COLS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("window, gram, leaves", [(12, 4, 2000), (12, 4, 2), (12, 3, 0), (7, 1, 3)])
def test_repeats(documents, window, gram, leaves):
    r = random.Random(5)
    base = [r.choice("abcdefgh") for _ in range(400)]
    rows = [(None, None), (None, " ".join(base[:30])), (1, ""), (2, "a"), (3, " ".join("ab" * 60)), (3, " ".join("ab" * 60)), (4, " ".join("a" * 50)), (4, " ".join(base[40:60]))]
    for i in range(40):
        t = []
        for _ in range(r.randint(0, 6)):
            s = r.randint(0, 350)
            t += base[s : s + r.randint(1, 60)] if r.random() < 0.5 else [r.choice("abcdefgh") for _ in range(r.randint(1, 30))]
            if r.random() < 0.3 and t:
                t[r.randrange(len(t))] = "é"
        rows.append((10 + i, " ".join(t)))
    got = without_repeats(documents(rows), window, gram, leaves)
    assert got.columns[:3] == ["doc_id", "text", "lang"]
    assert sorted((tuple(x) for x in got.select(*COLS).collect()), key=repr) == brute_repeats(rows, window)


def test_repeats_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((tuple(r) for r in without_repeats(docs).select(*COLS).collect()), key=repr)
    assert got == brute_repeats([(r["doc_id"], r["text"]) for r in docs.collect()], 35)


def test_no_documents(documents):
    assert without_repeats(documents([])).collect() == []


def edited(words, edits, r, moved=0.05):
    out = list(words)
    for _ in range(edits):
        i = r.randrange(len(out))
        kind = r.random()
        if kind < 0.7:
            out[i] = f"e{r.randrange(10**9)}" if r.random() < 0.8 else f"e{i % 7}"
        elif kind < 0.85:
            out.insert(i, f"i{r.randrange(10**9)}")
        else:
            out.pop(i)
    if r.random() < moved:  # a part
        i, n = r.randrange(len(out)), r.randrange(5, 30)
        part = out[i : i + n]
        del out[i : i + n]
        at = r.randrange(len(out))
        out[at:at] = part
    return out


def one_bucket():
    """A sketch by which all texts meet, so that what is linked follows from the texts alone."""

    class One:  # of this function, so that tasks get it by value
        def keys(self, items):
            return np.array([1] if len(items) else [], np.uint64)

    return One()


@pytest.mark.parametrize(("seed", "most_edits", "with_original"), [(1, 8, True), (2, 5, False)])
def test_large_buckets_lose_no_link(documents, seed, most_edits, with_original):
    """Copies of one text and of one copy, about half of them too far from it, against all pairs."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**9)}" for _ in range(90)]
    second = edited(base, 4, r)
    texts = {0: base} if with_original else {}
    texts |= {i: edited(base if r.random() < 0.7 else second, r.randrange(1, most_edits), r) for i in range(1, 150)}
    runs = {i: np.array([hash(tuple(t[j : j + 5])) & 2**63 - 1 for j in range(len(t) - 4)], np.uint64) for i, t in texts.items()}
    ids = sorted(runs)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if aligned(runs[a], runs[b], 0.8) >= 0.8]
    log = []
    got = near_classes(documents([(i, " ".join(t)) for i, t in texts.items()]), sketch=one_bucket(), log=log).collect()
    assert {x["doc_id"]: x["class_id"] for x in got} == roots(links, ids)
    assert len(log) <= 6, log


def test_rounds_and_pairs_of_a_large_group(documents):
    """2,000 copies with 20 strangers of the same bucket: a few rounds, pairs in proportion to the texts."""
    r = random.Random(9)
    base = [f"w{r.randrange(10**9)}" for _ in range(64)]
    texts = [edited(base, 1, random.Random(1000 + i), moved=0) for i in range(2000)]
    far = [[*base[32:], *base[:32]], *([f"s{r.randrange(10**9)}" for _ in range(60)] for _ in range(19))]
    log = []
    got = near_classes(documents([(i, " ".join(t)) for i, t in enumerate([base, *texts, *far])]), sketch=one_bucket(), log=log).collect()
    classes = Counter(x["class_id"] for x in got)
    assert classes[0] >= 1990 and sum(n == 1 for n in classes.values()) >= 19
    assert len(log) <= 4 and sum(n for _, n in log) <= 10_000, log


def test_marks_that_meet(spark):
    """Marks of several leads, one of them with more texts than a part has, against all of them."""
    r = random.Random(4)
    rows = [(1, 7, [], 700)]
    for lead, n in ((7, 700), (8, 40), (9, 1)):
        for i in range(n - (lead == 7)):
            marks = {r.randrange(-(2**62), 2**62) for _ in range(30)} | {2 * x + r.randint(0, 1) for x in r.sample(range(-(4**6), 4**6), 8)}
            rows.append((10 * i + lead, lead, list({m >> 1: m for m in [*marks, 10**9, 2 * lead]}.values()), n))
    has = {}
    for tid, lead, marks, _ in rows:
        for m in marks:
            has.setdefault((lead, m >> 1), set()).add(tid)
    want = {(tid, lead, m) for tid, lead, marks, _ in rows for m in marks if len(has[lead, m >> 1]) > 1}
    frame = spark.createDataFrame(rows, "tid long, lead long, marks array<long>, n long")
    for parts in (1, 5, 60):
        got = [tuple(x) for x in near_dedup._met(frame.repartition(parts)).collect()]
        assert set(got) == want and len(got) == len(want)


def test_no_rows_for_marks_of_one_text(documents, monkeypatch):
    """Copies of one text, half of them too far from it: what they alone differ in makes no rows."""
    r, dealt = random.Random(6), []
    base = [f"w{r.randrange(10**9)}" for _ in range(90)]
    texts = {0: base} | {i: edited(base, r.randrange(1, 9), r) for i in range(1, 600)}
    write_out = near_dedup.write_out

    def kept(df, label):
        out = write_out(df, label)
        if label == "dealt":
            dealt.append(Counter(x["bucket"] for x in out.collect()))
        return out

    monkeypatch.setattr(near_dedup, "write_out", kept)
    near_classes(documents([(i, " ".join(t)) for i, t in texts.items()]), sketch=one_bucket()).collect()
    assert dealt and sum(dealt[0].values()) > 100 and all(n > 1 for d in dealt for n in d.values())


def test_very_long_texts(documents):
    r = random.Random(3)
    long = [f"w{r.randrange(5000)}" for _ in range(60_000)]
    other = list(long)
    for i in range(0, 60_000, 97):
        other[i] = "x"
    got = near_classes(documents([(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(reversed(long)))])).collect()
    assert {x["doc_id"]: x["class_id"] for x in got} == {1: 1, 2: 1, 3: 3}


def test_least_places_and_unshared():
    r = np.random.default_rng(1)
    for n in (6, 7, 20, 300):
        rank = r.integers(0, 2**64, (24, n), np.uint64)
        if n == 20:
            rank[3] = 5  # equal values at the bound: some six places
        got = near_dedup.least_places(rank, 6)
        assert got.shape == (24, 6) and (np.diff(got, axis=1) > 0).all()
        assert (np.sort(np.take_along_axis(rank, got, 1)) == np.sort(rank)[:, :6]).all()
    for a, b in (([], []), ([3, 1], []), ([], [2]), ([9, 1, 4], [4, 2, 9]), ([1, 2, 3], [1, 2, 3])):
        a, b = np.array(a, np.uint64), np.array(b, np.uint64)
        more, missing = near_dedup.unshared(a, b)
        assert (more.tolist(), missing.tolist()) == (np.setdiff1d(a, b).tolist(), np.setdiff1d(b, a).tolist())


def test_runs_of_a_lead_are_made_once(monkeypatch):
    texts = ["a b c d e f g", "", "a b", None, "x y x y x y x y"]
    leads = ["a b c d e f h", "a b c d e f h", None, "", "a b c d e f h"]
    seen, labelled_of = [], near_dedup.labelled

    def counted(s, bounds):
        seen.append(len(bounds) - 1)
        return labelled_of(s, bounds)

    monkeypatch.setattr(near_dedup, "labelled", counted)
    own, other = near_dedup._paired_runs(pa.array(texts), pa.array(leads), 5)
    assert sum(seen) == len(texts) + 2  # the leads are one text, and nothing
    for side, want in ((own, texts), (other, leads)):
        for (s, items), t in zip(side, want):
            w = Words(*next(blocks(column(pa.array([t]))))[2:])
            h = w.hashes()
            n = len(runs(t))
            assert len(s) == len(items) == n and (np.diff(items.astype(object)) > 0).all()
            if n:
                k = min(5, len(h))
                left = np.arange(len(h), 0, -1)
                assert s.tolist() == window_hashes(h, k, left)[0][:n].tolist()


def test_bands_of_lone_texts_are_shuffled_once(documents, monkeypatch):
    """Only the look for bands of two texts goes through all bands; repeated rows, and an id of two texts, are no bucket."""
    r = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    twin = [*base[:30], "other", *base[31:]]
    alone = {i: " ".join(f"a{r.randrange(10**9)}" for _ in range(50)) for i in range(100, 140)}
    rows = [(1, " ".join(base)), (1, " ".join(base)), (1, " ".join(twin)), (None, " ".join(base)), (2, None), (3, ""), *alone.items(), *alone.items()]
    plans, met, write_out = {}, [], near_dedup.write_out

    def kept(df, label):
        plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        out = write_out(df, label)
        met.extend(out.collect() if label == "met" else [])
        return out

    monkeypatch.setattr(near_dedup, "write_out", kept)
    near = [*twin[:-1], "end"]
    got = {x["doc_id"]: x["class_id"] for x in near_classes(documents([*rows, (4, " ".join(near))])).collect()}
    assert got == {i: i for i in alone} | {1: 1, 4: 1, 2: 2, 3: 2, None: None}
    assert {x["tid"] for x in met} == {1, 4} and len(met) == len(set(met))
    assert all("Generate" not in plans[x] for x in ("sizes", "buckets")) and sum("w2" in p and "Join" in p for p in plans.values()) == 1
    met.clear()
    got = {x["doc_id"]: x["class_id"] for x in near_classes(documents(rows)).collect()}
    assert got == {i: i for i in alone} | {1: 1, 2: 2, 3: 2, None: None} and not met
