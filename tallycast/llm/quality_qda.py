"""Quality by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_out
from .arrays import Words, blocks, column, sums_by
from .learn import lowest, platt, remainder, sigmoid

#: Transformed statistics of one text; see ``statistics``.
FEATURES = (
    "log_words", "word_bytes", "word_spread", "upper", "symbols", "bars", "digits", "stops", "lines", "repeats",
    "same_next", "types", "top_word", "entropy",
)
_SETS = {
    "upper": list(range(65, 91)), "symbols": [ord(c) for c in "#*$%&<>!@^~="], "bars": [ord("|")],
    "digits": list(range(48, 58)), "stops": [ord(c) for c in ".,;:?"], "lines": [10],
}
_SHRINK = [(a, g) for a in (0.02, 0.1, 0.3, 0.6) for g in (1e-3, 1e-2, 1e-1)]


def _logit(part, whole):
    return np.log((part + 0.5) / (whole - part + 0.5))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics (log, logit), a row for each text of a block."""
    w = Words(data, offsets)
    h = w.hashes()
    n_docs, counts = len(offsets) - 1, w.counts.astype(float)
    size = np.maximum(np.diff(offsets).astype(float), 0)
    lengths = (w.stops - w.starts).astype(float)
    some = np.maximum(counts, 1)
    mean = sums_by(lengths, w.bounds) / some
    spread = np.sqrt(np.maximum(sums_by(lengths**2, w.bounds) / some - mean**2, 0))
    histogram = np.bincount(np.repeat(np.arange(n_docs), np.diff(offsets)) * 256 + data, minlength=n_docs * 256).reshape(n_docs, 256)
    p = histogram / np.maximum(size, 1)[:, None]
    entropy = -(p * np.log(np.where(p > 0, p, 1))).sum(1)
    owner = w.owner()
    order = np.lexsort((h, owner))
    so, sh = owner[order], h[order]
    new = np.ones(len(so), bool)
    new[1:] = (so[1:] != so[:-1]) | (sh[1:] != sh[:-1])
    types = np.bincount(so[new], minlength=n_docs).astype(float)
    first = np.flatnonzero(new)
    runs = np.diff(np.concatenate([first, [len(so)]]))
    top = np.zeros(n_docs)
    np.maximum.at(top, so[first], runs)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    cols = {
        "log_words": np.log1p(counts), "word_bytes": np.log1p(mean), "word_spread": np.log1p(spread),
        "repeats": _logit(counts - types, counts), "same_next": _logit(sums_by(same, w.bounds), counts),
        "types": np.log1p(types) / np.log(counts + 2), "top_word": _logit(top, counts), "entropy": entropy,
    } | {k: _logit(histogram[:, v].sum(1).astype(float), size) for k, v in _SETS.items()}
    return np.column_stack([cols[k] for k in FEATURES])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, FEATURES) of whole texts; a null or empty text has the statistics of no words."""

    def rows(batches):
        for batch in batches:
            texts = column(batch.column(1))
            parts = [statistics(d, o) for _, _, d, o in blocks(texts)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, j]) for j in range(x.shape[1]))], ["doc_id", *FEATURES])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, mean and covariance of each class, from sums that Spark makes."""
    d = len(FEATURES)
    sums = [F.count("*").alias("n"), *(F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES))]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    out = {}
    for r in rows.groupBy("y").agg(*sums).collect():
        n = r["n"]
        mu = np.array([r[f"s{i}"] for i in range(d)]) / n
        s = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                s[i, j] = s[j, i] = r[f"p{i}_{j}"] / n - mu[i] * mu[j]
        out[r["y"]] = (n, mu, s)
    return out


class Discriminant:
    """Two Gaussians with shrunken covariances; scores from their whitened distances."""

    def __init__(self, moments: dict, toward_pooled: float, toward_identity: float):
        total = sum(m[0] for m in moments.values()) or 1
        d = len(FEATURES)
        pooled = sum((m[0] * m[2] for m in moments.values()), np.zeros((d, d))) / total
        self.slope, self.shift = 1.0, 0.0
        self.parts = []
        for k in (0, 1):
            n, mu, s = moments.get(k, (0, sum((m[0] * m[1] for m in moments.values()), np.zeros(d)) / total, pooled))
            s = (1 - toward_pooled) * s + toward_pooled * pooled
            s = (1 - toward_identity) * s + (toward_identity * max(np.trace(s) / d, 1e-6) + 1e-6) * np.eye(d)
            low = np.linalg.cholesky(s)
            self.parts.append((mu, np.linalg.inv(low), np.log(np.diag(low)).sum(), np.log((n + 1) / (total + 2))))

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, priors included."""
        density = [prior - det - 0.5 * (((x - mu) @ white.T) ** 2).sum(1) for mu, white, det, prior in self.parts]
        return np.clip(density[1] - density[0], -1e6, 1e6)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(x) + self.shift)


def fit(labelled: DataFrame, calibrate_on: int = 5000) -> Discriminant:
    """Fit on (doc_id, y, FEATURES).

    Means and covariances are sums over all rows. The two shrinkage weights and
    the calibration are chosen on at most ``calibrate_on`` rows.
    """
    moments = _moments(labelled)
    some = lowest(labelled, calibrate_on, "y").toPandas()
    x, y = some[list(FEATURES)].to_numpy(float), some["y"].to_numpy(float)
    best = None
    for alpha, gamma in _SHRINK:
        model = Discriminant(moments, alpha, gamma)
        m = model.margin(x)
        model.slope, model.shift = platt(m, y, np.ones(len(y)))
        p = np.clip(sigmoid(model.slope * m + model.shift), 1e-9, 1 - 1e-9)
        loss = -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) if len(y) else 0.0
        if best is None or loss < best[0]:
            best = (loss, model)
    return best[1]


def quality_scores(
    docs: DataFrame, labels: DataFrame, mod: int = 5, out: int = 0, threshold: float = 0.3, calibrate_on: int = 5000
) -> DataFrame:
    """(doc_id, held_out, score, predicted, margin), a row for each document.

    Labels are learned from ids whose crc32 modulo ``mod`` is not ``out``.
    Rows without an id are scored, never learned from, and not held out. Several
    labels of one document are as many rows to learn from; a null label is none. Without labelled
    rows of both classes the score is the smoothed share of ones.
    """
    stats = write_out(document_statistics(docs), "quality")
    y = labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & (remainder("doc_id", mod) != out)
    )
    model = fit(stats.join(y, "doc_id"), calibrate_on)

    def score(batches):
        for batch in batches:
            x = np.column_stack([batch.column(j + 1).to_numpy() for j in range(len(FEATURES))])
            m = model.margin(x)
            p = sigmoid(model.slope * m + model.shift)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(m)], ["doc_id", "score", "margin"])

    return stats.mapInArrow(score, "doc_id long, score double, margin double").select(
        "doc_id",
        (remainder("doc_id", mod) == out).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        "margin",
    )


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
