"""The array kernel against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallycast.llm.arrays import PUNCTUATION, Words, blocks, column, window_hashes

R = random.Random(1)
TEXTS = [None, "", "  a bb\tc", "word", "x\x0by", "é à\n ü  z ", " ", "ends"] + [
    "".join(R.choice(" ab\né,") for _ in range(R.randint(0, 30))) for _ in range(200)
]


@pytest.mark.parametrize("limit", [1, 20, 1 << 20])
def test_words_grams_and_windows(limit):
    n = 0
    for lo, hi, data, offsets in blocks(column(pa.array(TEXTS)), limit):
        w = Words(data, offsets)
        h = w.hashes()
        norm = Words(data, offsets, PUNCTUATION)
        known, runs, windows = {}, {}, {}
        for i in range(lo, hi):
            raw = (TEXTS[i] or "").encode()
            want = re.findall(rb"[^\x20\x09-\x0D]+", raw)
            a, b = w.bounds[i - lo : i - lo + 2]
            assert [bytes(data[s:t]) for s, t in zip(w.starts[a:b], w.stops[a:b])] == want
            c, d = norm.bounds[i - lo : i - lo + 2]
            assert [bytes(data[s:t]) for s, t in zip(norm.starts[c:d], norm.stops[c:d])] == re.findall(rb"[a-zA-Z0-9\x80-\xff]+", raw)
            for j, word in enumerate(want):
                assert known.setdefault(word, h[a + j]) == h[a + j]
            g, bounds = w.grams(3)
            own = [raw[k : k + 3] for k in range(len(raw) - 2)]
            assert bounds[i - lo + 1] - bounds[i - lo] == len(own)
            for k, x in enumerate(own):
                assert runs.setdefault(x, g[bounds[i - lo] + k]) == g[bounds[i - lo] + k]
            wh, valid = window_hashes(h, 2, w.left())
            for j in range(len(want)):
                assert valid[a + j] == (j + 2 <= len(want))
                if valid[a + j]:
                    assert windows.setdefault(tuple(want[j : j + 2]), wh[a + j]) == wh[a + j]
            n += 1
        assert len(set(known.values())) == len(known)
    assert n == len(TEXTS)


def test_long_text_is_one_block():
    texts = column(pa.array(["a b " * 800_000, "c"]))
    got = [(lo, hi, len(data)) for lo, hi, data, _ in blocks(texts)]
    assert got == [(0, 1, 3_200_000), (1, 2, 1)]
    assert np.array_equal(Words(*list(blocks(texts))[0][2:]).counts, [1_600_000])
