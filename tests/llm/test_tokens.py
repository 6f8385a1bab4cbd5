"""Token counts and packing against greedy matching, the tokenizer's library and an item-wise packer."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from fixtures import documents  # noqa: F401

from tallycast.llm.packing import best_fit, cut, encoder, pack
from tallycast.llm.token_counts import LongestMatch, load_vocabulary, token_counts, vocabulary_path

ODD = [(None, "a b"), (1, None), (2, ""), (3, " \n"), (4, "word " * 5000), (5, "the <|endoftext|> end"), (5, "the <|endoftext|> end"), (6, "中文 123")]


def greedy(word, vocabulary, mark=b" "):
    s, i, n = mark + word, 0, 0
    while i < len(s):
        for j in range(len(s), i, -1):
            if s[i:j] in vocabulary and (i == 0) == s[i:j].startswith(mark):
                i, n = j, n + 1
                break
        else:
            return 0
    return n


def test_automaton_is_greedy():
    r = random.Random(3)
    for _ in range(150):
        vocabulary = {bytes(r.choice(b"ab ") if k == 0 else r.choice(b"abc") for k in range(r.randint(1, 5))) for _ in range(r.randint(1, 15))}
        automaton = LongestMatch(vocabulary)
        for _ in range(40):
            word = bytes(r.choice(b"abc") for _ in range(r.randint(1, 9)))
            assert automaton.count(word) == greedy(word, vocabulary), (vocabulary, word)


def test_counts_on_texts(spark, documents):
    vocabulary = set(load_vocabulary(vocabulary_path()))
    assert len(vocabulary) == 50_256
    rows = [(r["doc_id"], r["text"][:3000]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(20).collect()] + ODD
    got = Counter(tuple(r) for r in token_counts(documents(rows)).collect())
    want = Counter()
    for i, t in rows:
        words = (t or "").encode().split()
        want[(i, len((t or "").encode()), len(words), sum(greedy(w, vocabulary) for w in words), 0)] += 1
    assert got == want
    assert token_counts(documents([])).collect() == []


def test_plan_is_best_fit():
    r = random.Random(2)
    for _ in range(150):
        size = r.choice([5, 16, 64])
        histogram = Counter(r.randint(1, size) for _ in range(r.randint(0, 200)))
        plan, fill, got = best_fit(histogram, size), defaultdict(list), Counter()
        ranks = defaultdict(list)
        for length, rank, count, per_bin, first, used in plan.slots:
            ranks[length] += range(rank, rank + count * per_bin)
            for i in range(count * per_bin):
                fill[first + i // per_bin].append((used + i % per_bin * length, length))
                got[length] += 1
        assert got == histogram and all(v == list(range(len(v))) for v in ranks.values())
        assert sorted(fill) == list(range(plan.sequences))
        for pieces in fill.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= size
        bins = []
        for length in sorted(histogram.elements(), reverse=True):
            fits = [b for b in range(len(bins)) if bins[b] >= length]
            if fits:
                bins[min(fits, key=lambda b: bins[b])] -= length
            else:
                bins.append(size - length)
        assert plan.sequences <= len(bins) + 1
    with pytest.raises(ValueError):
        best_fit({9: 1}, 8)


def test_cut():
    assert cut(5, 8) == [(0, 5)] and cut(8, 8) == [(0, 8)] and cut(9, 8) == [(0, 1), (1, 8)] and cut(16, 8) == [(0, 8), (8, 8)]


@pytest.mark.parametrize("size", [2048, 64])
def test_packed_pieces(spark, documents, size):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    rows = [(r["doc_id"] + 100, r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ODD
    got = pack(documents(rows), size).toPandas()
    want = Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, (start, n) in enumerate(cut(len(ids), size)):
            want[(i, k, start, n, zlib.crc32(ids[start : start + n].tobytes()))] += 1
    ids = [None if np.isnan(x) else int(x) for x in got["doc_id"].astype(float)]
    assert Counter(zip(ids, got["piece"], got["start"], got["length"], got["ids_crc32"])) == want
    got = got.sort_values(["sequence_id", "offset"])
    assert (got["offset"] == got.groupby("sequence_id")["length"].cumsum() - got["length"]).all()
    totals = got.groupby("sequence_id")["length"].sum()
    assert totals.max() <= size and len(totals) <= np.ceil(got["length"].sum() / size) * 1.02 + 1


def test_no_documents(documents):
    assert pack(documents([])).collect() == []


def test_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    own, theirs = encoder(vocabulary_path()), Tokenizer.from_file(vocabulary_path())
    for t in ["a b", "a  b", " lead", "trail ", "\n x\n\n y", "it's <|endoftext|> z", "a\t b", "é ü", "12 34!! x", "a \n b", " \n ", "中文"]:
        assert own.encode_to_numpy(t, allowed_special="all").tolist() == theirs.encode(t, add_special_tokens=False).ids
