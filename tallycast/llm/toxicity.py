"""Toxicity by a classifier whose scores must not move when identity terms are swapped."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import PUNCTUATION, Words, blocks, column, mix, powers
from .learn import labelled_texts, logistic, platt, remainder, sigmoid

# Groups of identity terms that may stand for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrants", "natives", "refugees", "citizens"),
    ("old", "young"),
    ("deaf", "blind", "disabled"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)
_GROUP = {t: (g, i) for g, terms in enumerate(IDENTITY_TERMS) for i, t in enumerate(terms)}
_PREFIXES = (4, 5, 6, 7, 8)
_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]?")
_WORD = re.compile(r"\w+")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) of a block: each normalised word, and its first 4 to 8 bytes."""
    w = Words(data, offsets, PUNCTUATION)
    out, of = [w.hashes()], [w.owner()]
    sums, length = w.sums, w.stops - w.starts
    inverse = powers(len(data) + 1)[1]
    for n in _PREFIXES:
        at = np.flatnonzero(length >= n)
        s = w.starts[at]
        out.append(mix((sums[s + n] - sums[s]) * inverse[s] + np.uint64(n)))
        of.append(of[0][at])
    return np.concatenate(out), np.concatenate(of)


def _lower(texts) -> pa.Array:
    import pyarrow.compute as pc

    return pc.utf8_lower(column(texts))


def counterfactuals(texts: list[str]) -> list[tuple[str, str]]:
    """(sentence, the same with each identity term replaced by the next of its group)."""
    out = []
    for text in texts:
        for s in _SENTENCE.findall(text.lower()):
            swapped = _WORD.sub(
                lambda m: IDENTITY_TERMS[g[0]][(g[1] + 1) % len(IDENTITY_TERMS[g[0]])] if (g := _GROUP.get(m[0])) else m[0], s
            )
            if swapped != s:
                out.append((s, swapped))
    return out


class ToxicityModel:
    """Weights of a bounded vocabulary of features, calibrated."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        order = np.argsort(keys)
        self.keys, self.weights, self.bias, self.slope, self.shift = keys[order], weights[order], bias, slope, shift
        self.filter = np.zeros(1 << 20, bool)  # most features of a text are outside the vocabulary
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, texts: pa.Array):
        """(text, vocabulary index, log count) of a lower-cased column."""
        for lo, hi, data, offsets in blocks(texts):
            f, of = features(data, offsets)
            some = self.filter[(f >> np.uint64(44)).astype(np.int64)]
            f, of = f[some], of[some]
            at = np.minimum(np.searchsorted(self.keys, f), max(len(self.keys) - 1, 0))
            same = self.keys[at] == f if len(self.keys) else np.zeros(len(f), bool)
            pair, count = np.unique(of[same] * len(self.keys) + at[same], return_counts=True) if same.any() else (np.zeros(0, np.int64),) * 2
            k = max(1, len(self.keys))
            yield lo, hi, pair // k, pair % k, np.log1p(count)

    def margin(self, texts: pa.Array) -> np.ndarray:
        parts = [self.bias + np.bincount(row, self.weights[at] * v, hi - lo) for lo, hi, row, at, v in self.hits(texts)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probability(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.slope * self.margin(texts) + self.shift)


def _matrix(model: ToxicityModel, texts: list[str]):
    parts = [(row + lo, at, v) for lo, _, row, at, v in model.hits(_lower(pa.array(texts, pa.large_string())))]
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def fit(texts: list[str], y: np.ndarray, share: float, vocabulary: int = 4096, swap_weight: float = 5.0) -> ToxicityModel:
    """Choose the ``vocabulary`` features that separate the classes best, fit and calibrate.

    Features are ranked by the log likelihood ratio of their document counts.
    The loss is the log loss plus ``swap_weight`` times the mean squared change
    of a sentence's score when its identity terms are swapped.
    """
    none = np.zeros(0, np.uint64)
    if len(y) == 0 or y.min() == y.max():
        return ToxicityModel(none, np.zeros(0), 6.0 if len(y) and y[0] == 1 else -6.0)
    keys, ones = none, np.zeros(0, np.int64)
    zeros = ones
    for lo, hi, data, offsets in blocks(_lower(pa.array(texts, pa.large_string()))):
        f, of = features(data, offsets)
        order = np.lexsort((f, of))
        f, of = f[order], of[order]
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] != f[:-1]) | (of[1:] != of[:-1])
        f, cls = f[new], y[lo + of[new]]
        k, inv = np.unique(np.concatenate([keys, f]), return_inverse=True)
        n = len(keys)
        a = np.bincount(inv[n:], cls, len(k)) + np.bincount(inv[:n], ones, len(k))
        b = np.bincount(inv[n:], 1 - cls, len(k)) + np.bincount(inv[:n], zeros, len(k))
        keys, ones, zeros = k, a, b
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    p1, p0 = (ones + 0.5) / (n1 + 1), (zeros + 0.5) / (n0 + 1)
    p = (ones + zeros + 1) / (n1 + n0 + 2)
    gain = ones * np.log(p1 / p) + (n1 - ones) * np.log((1 - p1 + 1e-9) / (1 - p)) + zeros * np.log(p0 / p) + (n0 - zeros) * np.log((1 - p0 + 1e-9) / (1 - p))
    gain[ones + zeros < 3] = -1
    top = np.lexsort((keys, -gain))[:vocabulary]
    top = top[gain[top] > 0]
    model = ToxicityModel(keys[top], np.zeros(len(top)), 0.0)
    rows, cols, values = _matrix(model, texts)
    swaps = counterfactuals(texts)
    a, b = (_matrix(model, [s[i] for s in swaps]) for i in (0, 1))
    pairs = (np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], -b[2]]))
    test = np.arange(len(y)) % 5 == 4
    if len(set(y[test])) < 2 or len(set(y[~test])) < 2:
        test = np.zeros(len(y), bool)
    even = np.where(y == 1, 0.5 / max(1, (y[~test] == 1).sum()), 0.5 / max(1, (y[~test] == 0).sum())) * ~test
    keep = ~test[rows]
    w, bias = logistic(rows[keep], cols[keep], values[keep], y, even, len(top), l2=2e-4, pairs=pairs, pair_l2=swap_weight, steps=800)
    model.weights, model.bias = w, bias
    margin = bias + np.bincount(rows, w[cols] * values, len(y))
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    on = test if test.any() else ~test
    model.slope, model.shift = platt(margin[on], y[on], weight[on])
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, mod: int = 4, out: int = 2, per_class: int = 1500) -> ToxicityModel:
    """Learn from at most ``per_class`` labelled rows of each class whose id's crc32 modulo ``mod`` is not ``out``."""
    return fit(*labelled_texts(docs, labels, "toxic", mod, out, per_class))


def with_toxicity(docs: DataFrame, model: ToxicityModel, score: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability that the whole ``text`` is toxic.

    A null or empty text gets the score of a text without any known feature. A
    model that saw labels of one class only gives each text that class's score
    (no labels at all: not toxic).
    """
    at = docs.columns.index("text")

    def rows(batches):
        for batch in batches:
            p = pa.array(model.probability(_lower(batch.column(at))))
            yield pa.RecordBatch.from_arrays([*batch.columns, p], [*batch.schema.names, score])

    return docs.mapInArrow(rows, T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())]))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, mod: int = 4, out: int = 2, per_class: int = 1500, threshold: float = 0.3
) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each document."""
    scored = with_toxicity(docs.select("doc_id", "text"), fit_toxicity(docs, labels, mod, out, per_class))
    return scored.select(
        "doc_id",
        (remainder("doc_id", mod) == out).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity_scores(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
