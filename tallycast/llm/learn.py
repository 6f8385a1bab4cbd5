"""Bounded labelled samples and the small fits that the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; -1 without an id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % mod, F.lit(-1))


def lowest(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """At most ``n`` rows, chosen by the hash of the id; the same rows on every run."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", *order).limit(n)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, mod: int, out: int, per_class: int):
    """(texts, 0/1 labels, share of ones among all learning rows).

    Learning rows are those of ``labels`` with a label and an id whose
    remainder is not ``out``. The sample has at most ``per_class`` rows of each
    class, so what is broadcast and gathered here is bounded by that parameter.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & (remainder("doc_id", mod) != out) & F.col("doc_id").isNotNull()
    )
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    ids = lowest(rows.filter("y = 0"), per_class).unionByName(lowest(rows.filter("y = 1"), per_class))
    got = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y").toPandas()
    got = got.sort_values(["doc_id", "y"], kind="stable")
    return got["text"].fillna("").tolist(), got["y"].to_numpy(np.int64), n.get(1, 0) / max(1, sum(n.values()))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(rows, cols, values, y, weight, n_features, l2=1e-3, pairs=None, pair_l2=0.0, steps=150):
    """Weights and intercept of a sparse logistic regression.

    ``pairs`` = (rows, cols, values) holds differences of feature vectors whose
    score differences are pushed to zero with strength ``pair_l2``. Accelerated
    gradient steps on coordinates scaled by a bound of their curvature.
    """
    n = len(y)
    w, b = np.zeros(n_features), 0.0
    weight = weight / max(weight.sum(), 1e-9)

    def bound(rows, cols, values, scale):
        """Diagonal that is at least the curvature: each value times the sum of its row."""
        size = np.abs(values)
        return np.bincount(cols, size * np.bincount(rows, size)[rows] * scale, n_features)

    curvature = bound(rows, cols, values, weight[rows] / 4) + l2 if len(rows) else np.full(n_features, l2)
    n_pairs = 0
    if pairs is not None and len(pairs[0]):
        n_pairs = int(pairs[0].max()) + 1
        curvature = curvature + bound(*pairs, 2 * pair_l2 / n_pairs)
    step = 1 / (2 * curvature)  # halved: the intercept takes the other half
    v, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        z = np.bincount(rows, values * v[cols], n) + vb
        e = (sigmoid(z) - y) * weight
        g = np.bincount(cols, values * e[rows], n_features) + l2 * v
        if n_pairs:
            d = np.bincount(pairs[0], pairs[2] * v[pairs[1]], n_pairs)
            g += 2 * pair_l2 / n_pairs * np.bincount(pairs[1], pairs[2] * d[pairs[0]], n_features)
        new, new_b = v - step * g, vb - 2 * e.sum()
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        if (g * (new - w)).sum() > 0:  # the momentum went uphill: begin anew
            t, t_new = 1.0, 1.0
        v, vb = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return w, float(b)


def platt(scores: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (above zero) and shift that calibrate scores to probabilities, by Newton steps."""
    if len(y) == 0 or y.min() == y.max():
        p = (weight @ y + 1) / (weight.sum() + 2)
        return 1.0, float(np.log(p / (1 - p)) - (np.median(scores) if len(scores) else 0.0))
    s, m = scores.std() or 1.0, scores.mean()
    x = np.column_stack([(scores - m) / s, np.ones(len(scores))])
    ones, zeros = weight @ y, weight @ (1 - y)
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    beta = np.array([1.0, 0.0])
    ridge = 1e-4 * weight.sum() * np.eye(2)
    for _ in range(50):
        p = sigmoid(x @ beta)
        grad = x.T @ (weight * (p - target)) + ridge @ beta
        beta = beta - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, grad)
        beta = np.clip(beta, -30, 30)
    slope = max(beta[0], 1e-3) / s
    return float(slope), float(beta[1] - slope * m)
