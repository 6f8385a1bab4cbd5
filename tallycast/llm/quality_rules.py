"""Quality rules: exact counts of a text, and a hashed n-gram logistic regression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import SPACE, Words, blocks, column, mix, sums_by, window_hashes
from .learn import labelled_texts, logistic, platt, sigmoid

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_KINDS = 4


def _repeated(w: Words, h: np.ndarray, k: int) -> np.ndarray:
    """Words of each text that lie in a k-word window found twice or more in it."""
    g, valid = window_hashes(h, k, w.left())
    owner = w.owner()
    at = np.flatnonzero(valid)
    out = np.zeros(len(w.counts), np.int64)
    if not len(at):
        return out
    order = at[np.lexsort((g[at], owner[at]))]
    twin = np.zeros(len(order), bool)
    twin[1:] = (g[order[1:]] == g[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    for i in np.unique(owner[order[twin]]):  # only texts with a repeat; their words are compared themselves
        b, e = w.bounds[i], w.bounds[i + 1]
        words = [bytes(w.data[s:t]) for s, t in zip(w.starts[b:e], w.stops[b:e])]
        seen: dict[tuple, int] = {}
        flag = np.zeros(e - b, bool)
        for j, window in enumerate(zip(*(words[r:] for r in range(k)))):
            first = seen.setdefault(window, j)
            if first != j:
                flag[j : j + k] = flag[first : first + k] = True
        out[i] = flag.sum()
    return out


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, w: Words) -> np.ndarray:
    """Lines of each text that have a word and equal an earlier line of it."""
    out = np.zeros(len(offsets) - 1, np.int64)
    newlines = np.searchsorted(np.flatnonzero(data == 10), offsets)
    for i in np.flatnonzero((np.diff(newlines) > 0) & (w.counts > 1)):
        lines = bytes(data[offsets[i] : offsets[i + 1]]).split(b"\n")
        seen: set[bytes] = set()
        for line in lines:
            if line in seen:
                out[i] += 1
            elif line.strip(b" \t\n\r\x0b\x0c"):
                seen.add(line)
    return out


def base_counts(data: np.ndarray, offsets: np.ndarray, w: Words, h: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    chars = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & ~SPACE[data])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    return [
        w.counts.astype(np.int64), chars[offsets[1:]] - chars[offsets[:-1]], symbols[offsets[1:]] - symbols[offsets[:-1]],
        _repeated_lines(data, offsets, w), _repeated(w, h, 5),
    ]


def hashed_features(w: Words, h: np.ndarray, bits: int):
    """(bucket, bounds of the texts) of words, word pairs, 3- and 5-byte runs."""
    shift = np.uint64(64 - bits)
    pair, valid = window_hashes(h, 2, w.left())
    n_valid = np.concatenate([[0], np.cumsum(valid)])
    out = [(h >> shift, w.bounds), (mix(pair[valid]) >> shift, n_valid[w.bounds])]
    for n in (3, 5):
        g, bounds = w.grams(n)
        out.append((g >> shift, bounds))
    return [((b + np.uint64(k << bits)).astype(np.int64), bounds) for k, (b, bounds) in enumerate(out)]


class NgramQuality:
    """Mean weight of each kind of n-gram, summed and calibrated."""

    def __init__(self, weights: np.ndarray, bias: float, bits: int, slope: float = 1.0, shift: float = 0.0):
        self.weights, self.bias, self.bits, self.slope, self.shift = weights, bias, bits, slope, shift

    def margin(self, w: Words, h: np.ndarray) -> np.ndarray:
        z = np.full(len(w.counts), self.bias)
        for bucket, bounds in hashed_features(w, h, self.bits):
            z += sums_by(self.weights[bucket], bounds) / np.maximum(np.diff(bounds), 1)
        return z

    def probability(self, w: Words, h: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(w, h) + self.shift)


def _sparse(texts: list[str], bits: int):
    rows, cols, values, at = [], [], [], 0
    for lo, hi, data, offsets in blocks(column(pa.array(texts, pa.large_string()))):
        w = Words(data, offsets)
        h = w.hashes()
        for bucket, bounds in hashed_features(w, h, bits):
            n = np.diff(bounds)
            key, count = np.unique((np.repeat(np.arange(lo, hi), n) << (bits + 2)) | bucket, return_counts=True)
            row = key >> (bits + 2)
            rows.append(row)
            cols.append(key & ((1 << (bits + 2)) - 1))
            values.append(count / np.maximum(n[row - lo], 1))
        at = hi
    return (np.concatenate(rows), np.concatenate(cols), np.concatenate(values)) if at else (np.zeros(0, int),) * 3


def fit(texts: list[str], y: np.ndarray, share: float, bits: int = 14) -> NgramQuality:
    """Learn on four fifths of the sample, calibrate on the rest; classes weigh as among all rows."""
    if len(y) == 0 or y.min() == y.max():
        return NgramQuality(np.zeros(_KINDS << bits), 6.0 if share >= 0.5 or len(y) == 0 else -6.0, bits)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    test = np.arange(len(y)) % 5 == 4
    if len(set(y[test])) < 2 or len(set(y[~test])) < 2:
        test = np.zeros(len(y), bool)
    rows, cols, values = _sparse(texts, bits)
    # rows of equal class mass in learning; the prior comes back with the calibration
    even = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * ~test
    keep = ~test[rows]
    w, b = logistic(rows[keep], cols[keep], values[keep] * 30, y, even, _KINDS << bits, l2=2e-4, steps=120)
    model = NgramQuality(w * 30, b, bits)
    margin = np.bincount(rows, values * model.weights[cols], len(y)) + b
    on = test if test.any() else ~test
    model.slope, model.shift = platt(margin[on], y[on], weight[on])
    return model


def quality_rules(
    docs: DataFrame, labels: DataFrame, per_class: int = 800, bits: int = 14, keep_at: float = 0.3,
    min_words: int = 10, repeat_percent: int = 20,
) -> DataFrame:
    """Counts, base verdict and kept flag of each document.

    A text fails the base rules with fewer than ``min_words`` words or with
    more than ``repeat_percent`` per cent of them in repeated 5-word windows;
    other texts are kept from the probability ``keep_at`` on. The model learns
    from at most ``per_class`` labelled rows of each class. A null text has no
    words. Without labels of both classes the base rules decide alone (all
    labelled 0: nothing is kept).
    """
    model = fit(*labelled_texts(docs, labels, "quality", 1, -2, per_class), bits)

    def rows(batches):
        for batch in batches:
            texts = column(batch.column(1))
            parts = []
            for _, _, data, offsets in blocks(texts):
                w = Words(data, offsets)
                h = w.hashes()
                parts.append([*base_counts(data, offsets, w, h), model.probability(w, h)])
            if not parts:
                continue
            cols = [np.concatenate(c) for c in zip(*parts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, cols)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"],
            )

    counts = docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return counts.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= keep_at))


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
