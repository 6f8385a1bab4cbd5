"""Leaks: edit distance, exact and edited passages, recall, edge cases."""

import random
import re

import pyarrow as pa
import pytest
from conftest import SF
from fixtures import documents  # noqa: F401

from tallycast.llm.arrays import PUNCTUATION, Words, blocks
from tallycast.llm.decontamination import Items, Sampling, edit_distance, leaks, leaks_of_block, normalised, without_leaks

R = random.Random(4)


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_edit_distance():
    for _ in range(400):
        item = [R.randint(0, 4) for _ in range(R.randint(1, 8))]
        text = [R.randint(0, 4) for _ in range(R.randint(0, 12))]
        best = min(distance(item, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1))
        d, start, end = edit_distance(item, text, 99)
        assert d == best == distance(item, text[start:end])
        assert edit_distance(item, text, 0)[0] == min(best, 1)


@pytest.fixture
def bench(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def edited(x, rate, voc):
    x = list(x)
    for _ in range(int(rate * len(x))):
        j, kind = R.randrange(len(x)), R.random()
        if kind < 0.34:
            x[j] = R.choice(voc)
        elif kind < 0.67:
            x.pop(j)
        else:
            x.insert(j, R.choice(voc))
    return x


def found_share(texts, rate, voc):
    """Share of items found in a text that holds them with edits between 40 other words on each side."""
    items = Items(list(range(len(texts))), [" ".join(x) for x in texts], 0.2, Sampling())
    held = [" ".join([*R.choices(voc, k=40), *edited(x, rate, voc), *R.choices(voc, k=40)]) for x in texts]
    got = set()
    for lo, _, data, offsets in blocks(normalised(pa.array(held))):
        w = Words(data, offsets, PUNCTUATION)
        got |= {(lo + x[0], items.ids[x[1]]) for x in leaks_of_block(items, w, w.hashes())}
    return len({(k, k) for k in range(len(texts))} & got) / len(texts)


@pytest.mark.parametrize("rate, least", [(0, 1.0), (0.05, 0.99), (0.1, 0.98), (0.2, 0.95)])
def test_recall(bench, rate, least):
    texts = [words(r["text"]) for r in bench.collect()] * 5
    assert found_share(texts, rate, [x for t in texts for x in t]) >= least


@pytest.mark.parametrize("size", [8, 11, 12, 16, 20, 23, 24, 30, 40, 59, 100, 200, 400])
def test_recall_by_length(size):
    """250 items of each length over 3,000 words, at a fifth of the words edited and at a tenth."""
    voc = [f"w{i}" for i in range(3000)]
    texts = [R.choices(voc, k=size) for _ in range(250)]
    assert found_share(texts, 0.2, voc) >= 0.95
    assert found_share(texts, 0.1, voc) >= 0.98


def test_documents_that_hold_an_item(spark, bench):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in leaks(docs, bench).filter("distance = 0").collect()}
    items = [(r["item_id"], " " + " ".join(words(r["text"])) + " ") for r in bench.collect()]
    texts = [(r["doc_id"], " " + " ".join(words(r["text"])) + " ") for r in docs.collect()]
    assert got == {(d, i) for d, t in texts for i, x in items if x in t}
    kept = {r["doc_id"] for r in without_leaks(docs, bench).collect()}
    assert kept == {d for d, _ in texts} - {r["doc_id"] for r in leaks(docs, bench).collect()}


def test_blocks_of_items_give_the_same(spark, bench):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, many = (sorted(tuple(r) for r in leaks(docs, bench, block_bytes=b).collect()) for b in (1 << 20, 4000))
    assert one == many


def test_odd_rows(spark, documents):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = spark.createDataFrame([(1, item), (2, None), (3, " .. "), (4, "one"), (None, "solo item here with no id at all")], "item_id long, text string")
    rows = [
        (None, f"x {item} y"), (1, None), (2, ""), (3, "  "), (4, f"q {item.upper().replace(' ', ', ')}!"), (4, f"q {item.upper().replace(' ', ', ')}!"),
        (5, "none of it"), (6, "word " * 20_000 + item), (7, "alpha beta gamma delta epsilon zeta eta theta iota"), (8, "one two"), (9, f"{item} {item}"),
    ]
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in leaks(documents(rows), bench).collect()), key=repr)
    assert got == sorted([(None, 1, 0), (4, 1, 0), (4, 1, 0), (6, 1, 0), (7, 1, 1), (8, 4, 0), (9, 1, 0)], key=repr)
    kept = without_leaks(documents(rows), bench)
    assert kept.columns == documents([]).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5]
    assert leaks(documents([]), bench).collect() == []
    assert leaks(documents(rows), bench.limit(0)).collect() == []
