"""Token links against the tokenizers' libraries and plain counting, containers against sets."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from fixtures import documents  # noqa: F401

from tallycast.llm import token_links as T
from tallycast.llm.token_counts import byte_symbols


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    symbol = byte_symbols()

    def groups(text):
        if not text:
            return None
        e, ids = a.encode(" " + text, add_special_tokens=False), b.encode(text)
        left = [(i, bytes(symbol[c] for c in x)) for i, x in zip(e.ids, e.tokens)]
        right = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids]
        if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (left, right)):
            return None
        ends = []
        for side in (left, right):
            at, out = 0, {}
            for i, x in side:
                at += len(x)
                out[at] = i
            ends.append(out)
        cuts, done = sorted(ends[0].keys() & ends[1].keys()), 0
        found = []
        for c in cuts:
            found.append(tuple([i for at, i in e.items() if done < at <= c] for e in ends))
            done = c
        return found

    def documents(rows):
        all_groups = [(i, groups(t)) for i, t in rows]
        count = Counter((g[0][-1], g[1][-1]) for _, gs in all_groups for g in gs or [])
        docs = Counter(p for _, gs in all_groups for p in {(g[0][-1], g[1][-1]) for g in gs or []})
        best = {}
        for (_, y), n in count.items():
            best[y] = max(best.get(y, 0), n)
        out = []
        for i, gs in all_groups:
            if gs is None:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
                continue
            pairs = [(g[0][-1], g[1][-1]) for g in gs]
            text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in gs)
            sums = sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs)
            out.append((i, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), len(gs), *sums, hashlib.sha256(text.encode()).hexdigest()))
        return Counter(out), {(*p, docs[p], n, n == best[p[1]]) for p, n in count.items()}

    return documents


ODD = [
    (None, "no id"), (1, None), (2, ""), (3, " \n\t  two  "), (4, "<|endoftext|> <s> <0x41> </s>"), (5, "中文 ümlaut 🙂 é"), (6, "a ▁ b"),
    (7, "x" * 3000), (8, "again and again " * 4000), (9, "\x00 nul"), (10, "same text"), (10, "same text"), (11, " "), (12, "ﬁ ½ ​ "),
]


def test_against_the_libraries(spark, documents, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()] + ODD + [(99, "hot text here")] * 50
    got, pairs = T.token_links(documents(rows))
    want, want_pairs = plain(rows)
    assert Counter(map(tuple, got.collect())) == want
    assert set(map(tuple, pairs.collect())) == want_pairs


def test_without_documents(documents):
    for rows in ([], [(1, None), (2, "")]):
        got, pairs = T.token_links(documents(rows))
        assert sorted(map(tuple, got.collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]
        assert pairs.collect() == []


def test_many_blocks(spark, plain):
    """Blocks closed by links: the sums over blocks are those over the corpus."""
    rows = [(i, f"a b {i % 7} c, d. " * (1 + i % 5)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got, pairs = T.token_links(docs, block_links=300)
    want, want_pairs = plain(rows)
    assert Counter(map(tuple, got.collect())) == want
    assert set(map(tuple, pairs.collect())) == want_pairs
    linked = T.linked(docs, T.vocabulary_path(), T.vocabulary_path("piece_bpe_32k.model"), 300)
    assert linked.select("block").distinct().count() > 20


@pytest.mark.parametrize("rows", [0, 5, 3000, 20_000])
def test_containers_hold_their_sets(rows):
    r = random.Random(rows)
    want = {}
    for key in (3, 8, 1 << 40):
        for row in r.sample(range(T.BLOCK_ROWS), rows):
            want[key, row] = r.choice([1, 1, 2, 5, 900])
    items = sorted(want.items())
    keys, places, times = (np.array(c, np.int64) for c in ([k for (k, _), _ in items], [x for (_, x), _ in items], [n for _, n in items]))
    heads, planes = T.containers(keys, places, times)
    assert heads.tolist() == sorted(set(keys.tolist()))
    for column in (planes, pa.concat_arrays([planes, planes]).slice(len(planes))):
        got = Counter()
        for i, plane, row in zip(*(x.tolist() for x in T.members(column))):
            got[int(heads[i]), row] += 1 << plane
        assert got == Counter(want)
    if rows > T.DENSE:
        assert max(len(x.as_py()) for x in planes.flatten()) == T.BLOCK_ROWS // 8
