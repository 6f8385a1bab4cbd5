"""Greedy word-piece counts of whole texts by a longest-match automaton."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .arrays import column

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: What a word begins with in the vocabulary: the blank before it.
WORD_MARK = b" "


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, by rule: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_vocabulary(path: str) -> list[bytes]:
    """Pieces, as bytes, of a byte-level ``tokenizers`` file; special tokens are none."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    symbol = byte_symbols()
    return [bytes(symbol[c] for c in piece) for piece in spec["model"]["vocab"] if piece not in special]


class LongestMatch:
    """Trie of pieces with failure links and the number of pieces that each link gives off.

    A word is its mark and its bytes; pieces that begin with the mark can only
    stand first, the others only later, so each of the two sorts has a root.
    ``link[v]`` is the node for what remains of the string of ``v`` once its
    greedy pieces are popped, ``popped[v]`` is how many those are; -1 means that
    greedy matching fails there. A word is then read once, byte by byte, and no
    piece is ever built.
    """

    def __init__(self, pieces: Iterable[bytes], mark: bytes = WORD_MARK):
        self.mark = mark
        self.step: dict[int, int] = {}
        ends = [False, False]
        level: list[list[tuple[int, int, int]]] = []
        for piece in pieces:
            head = piece.startswith(mark)
            body = piece[len(mark) :] if head else piece
            node = 0 if head else 1
            if not body:
                ends[node] = ends[node] or head
                continue
            for depth, byte in enumerate(body):
                key = node << 8 | byte
                child = self.step.get(key)
                if child is None:
                    child = self.step[key] = len(ends)
                    ends.append(False)
                    if depth == len(level):
                        level.append([])
                    level[depth].append((node, byte, child))
                node = child
            ends[node] = True
        self.link = [-1] * len(ends)
        self.popped = [0] * len(ends)
        if ends[0]:  # the mark alone is a piece
            self.link[0], self.popped[0] = 1, 1
        for edges in level:
            for parent, byte, child in edges:
                if ends[child]:
                    self.link[child], self.popped[child] = 1, 1
                    continue
                z, n = self.link[parent], self.popped[parent]
                while z >= 0 and z << 8 | byte not in self.step:
                    n += self.popped[z]
                    z = self.link[z] if z != 1 else -1
                if z >= 0:
                    self.link[child], self.popped[child] = self.step[z << 8 | byte], n

    def count(self, word: bytes) -> int:
        """Pieces of one word without its mark; 0 where greedy matching fails."""
        step, link, popped = self.step, self.link, self.popped
        node = n = 0
        for byte in word:
            key = node << 8 | byte
            while key not in step:
                if node == 1 or link[node] < 0:
                    return 0
                n += popped[node]
                node = link[node]
                key = node << 8 | byte
            node = step[key]
        while node != 1:
            if link[node] < 0:
                return 0
            n += popped[node]
            node = link[node]
        return n


class _Counts(dict):
    """Counts of words met before; the automaton reads each new word once."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:  # memory only: words are read anew
            self.clear()
        n = self[word] = self.automaton.count(word)
        return n


_workers: dict[str, _Counts] = {}


def _counts(path: str) -> _Counts:
    if path not in _workers:
        _workers[path] = _Counts(LongestMatch(load_vocabulary(path)))
    return _workers[path]


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_words, n_tokens, n_unknown), a row for each document.

    Words are split at blanks, tabs and line ends. ``n_tokens`` sums the greedy
    longest-match pieces of each word; a word that greedy matching can't finish
    is one token and counts in ``n_unknown``. A null text counts as empty.
    ``vocabulary`` is a file that every executor has at that path.
    """
    path = vocabulary or vocabulary_path()

    def rows(batches):
        known = _counts(path)
        for batch in batches:
            out = ([], [], [], [])
            for text in column(batch.column(1)):
                raw = text.as_buffer().to_pybytes()
                words = raw.split()
                counts = list(map(known.__getitem__, words))
                unknown = counts.count(0)
                for c, v in zip(out, (len(raw), len(words), sum(counts) + unknown, unknown)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in out)], ["doc_id", "n_bytes", "n_words", "n_tokens", "n_unknown"]
            )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_bytes long, n_words long, n_tokens long, n_unknown long")


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf}/documents.parquet"))
