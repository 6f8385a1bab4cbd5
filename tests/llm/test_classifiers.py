"""Quality, quality rules, toxicity and language: held-out accuracy, exact counts, edge cases."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from fixtures import documents, labels  # noqa: F401

from tallycast.llm import language, quality_qda, quality_rules, toxicity
from tallycast.llm.learn import logistic, platt, sigmoid
from tallycast.llm.queries import QUERIES

BIG = SF.replace("sf0.001", "sf0.01")
ODD = [(None, "a b"), (1, None), (2, ""), (3, " \n"), (4, "x " * 30_000), (5, "the end"), (5, "the end"), (6, "中文 123 $$")]
EMPTY_LABELS = []


def auc(score, y):
    pos, neg = score[y == 1], score[y == 0]
    return (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()


@pytest.mark.parametrize("name, label, least", [("op3_quality", "quality", 0.95), ("op6_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").toPandas()
    assert got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.3)).all()
    held = got[got["held_out"]]
    assert auc(held["score"].to_numpy(), held[label].to_numpy()) > least


def test_language_held_out(spark):
    got = QUERIES["op4_language"](spark, BIG).join(spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


@pytest.mark.parametrize("name", ["op3_quality", "op4_language", "op6_toxicity", "op7_quality_rules"])
def test_same_result_twice(spark, name):
    a, b = (sorted(map(tuple, QUERIES[name](spark, SF).collect()), key=repr) for _ in range(2))
    assert a == b and len(a) == 200


@pytest.mark.parametrize(
    "run, has",
    [
        (lambda d, y: quality_qda.quality_scores(d, y), "score"),
        (lambda d, y: toxicity.toxicity_scores(d, y), "score"),
        (lambda d, y: quality_rules.quality_rules(d, y), "kept"),
    ],
)
def test_odd_rows_and_labels(documents, labels, run, has):
    for y in ([], [(1, None, None, "t", 1)], [(1, 1, 1, "t", 0), (5, 1, 1, None, 1)], [(5, 0, 0, "", 1), (4, 1, 1, "", 0), (None, 1, 1, "", 0), (5, 0, 0, "", 1)]):
        got = run(documents(ODD), labels(y)).collect()
        assert len(got) == len(ODD) and all(r[has] is not None for r in got)
        assert not [r for r in got if r["doc_id"] is None and "held_out" in r.asDict() and r["held_out"]]
    assert run(documents([]), labels([])).collect() == []


def test_language_odd_rows(documents):
    learn = [(i, t, g) for i, (t, g) in enumerate([("der die das und nicht", "de"), ("the and of not with", "en"), ("и в не на", "ru")] * 8)]
    model = language.LanguageModel.fit([t for _, t, _ in learn], [g for *_, g in learn])
    got = {r["doc_id"]: r for r in language.label_texts(documents(ODD + [(9, "12 34 !!")]), model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 3, 9))
    assert got[5]["lang_pred"] == "en" and len(got) == 8
    none = language.label_texts(documents(ODD), language.LanguageModel.fit([], []))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert language.label_texts(documents([]), model).collect() == []
    mixed = documents([(1, "the and of with not the of " * 3 + "der die das und nicht die das " * 3)])
    spans = [(r["first_word"], r["end_word"], r["lang"]) for r in language.label_texts(mixed, model, spans=True).collect()]
    assert spans == [(0, 21, "en"), (21, 42, "de")]
    # a script that only one language uses rules the others out
    assert language.label_texts(documents([(1, "привет")]), model).first()["lang_pred"] == "ru"


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(0)
    for _ in range(60):
        lengths = r.integers(0, 6, 4)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        s = r.normal(0, 3, (bounds[-1], 3)).astype(np.float32)
        path = language.viterbi(s, bounds, 2.0)
        for a, b in zip(bounds[:-1], bounds[1:]):
            value = lambda p: sum(s[a + i, k] for i, k in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: E731, B023
            every = [[]]
            for _ in range(b - a):
                every = [[*p, k] for p in every for k in range(3)]
            assert value(path[a:b]) == pytest.approx(max(map(value, every)), abs=1e-4)


def test_gaussian_scores_match_the_densities():
    r = np.random.default_rng(3)
    d = len(quality_qda.FEATURES)
    x0, x1 = r.normal(0, 1, (400, d)), r.normal(0.5, 2, (300, d))
    moments = {k: (len(x), x.mean(0), np.cov(x.T, bias=True)) for k, x in ((0, x0), (1, x1))}
    m = quality_qda.Discriminant(moments, 0.1, 0.01)
    for (mu, white, det, _), x in zip(m.parts, (x0, x1)):
        s = np.linalg.inv(white.T @ white)
        assert det == pytest.approx(np.linalg.slogdet(s)[1] / 2)
        assert np.allclose(((x - mu) @ white.T)[0] @ ((x - mu) @ white.T)[0], (x - mu)[0] @ np.linalg.solve(s, (x - mu)[0]))
    assert (m.margin(x1) > m.margin(x0).mean()).mean() > 0.95


def test_swapped_identity_terms_keep_the_score():
    bad = ["you are an idiot and muslim people too"] * 30 + ["idiot moron muslim"] * 10
    good = ["nice day in the park today"] * 30 + ["the christian people read books"] * 10
    y = np.array([1] * 40 + [0] * 40)
    free = toxicity.fit(bad + good, y, 0.5, swap_weight=0.0)
    held = toxicity.fit(bad + good, y, 0.5, swap_weight=50.0)
    gap = lambda m: abs(np.diff(m.margin(toxicity._lower(pa.array(["the muslim people read", "the christian people read"])))))[0]
    assert gap(held) < 0.2 * gap(free)
    p = held.probability(toxicity._lower(pa.array(["idiot", "the muslim people read books", None, ""])))
    assert p[0] > 0.5 and p[0] > p[1]
    assert toxicity.counterfactuals(["Men read. Fine."]) == [("men read.", "girls read.")]


def test_logistic_and_platt():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 3))
    y = (x @ [2, -1, 0] + r.normal(size=400) > 0).astype(int)
    rows, cols = np.repeat(np.arange(400), 3), np.tile(np.arange(3), 400)
    w, b = logistic(rows, cols, x.ravel(), y, np.ones(400), 3, l2=1e-3, steps=400)
    p = sigmoid(x @ w + b)
    assert abs((x * (p - y)[:, None]).mean(0) + 1e-3 * w).max() < 1e-3
    slope, shift = platt(x @ w, y, np.ones(400))
    assert abs((sigmoid(slope * (x @ w) + shift) - y).mean()) < 0.01 and slope > 0


def brute_counts(text):
    raw = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", raw)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    lines, dup = set(), 0
    for line in raw.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", raw)), dup, len(hit)


def test_base_counts(spark, documents, labels):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += [None, "", "a\n\n \na\na ", "é é é é é é", "x y z x y z x y z x y z", "\x1ca\x0bb c", "| # a\r\na\r\n a"]
    docs = documents(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs, labels([])).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        want = brute_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, t
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_learned_rules_keep_good_rows(spark):
    got = QUERIES["op7_quality_rules"](spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").toPandas()
    sound = got[~got["base_failed"]]
    assert sound[sound["quality"] == 1]["kept"].mean() > 0.99
    assert sound[sound["quality"] == 0]["kept"].mean() < 0.2


def test_toxicity_learns_from_1500_of_each_class(monkeypatch):
    from tallycast.llm import toxicity

    monkeypatch.setattr(toxicity, "labelled_texts", lambda *a: a[-1:])
    monkeypatch.setattr(toxicity, "fit", lambda per_class: per_class)
    assert toxicity.fit_toxicity(None, None) == 1500


def test_a_rare_language_is_learned(spark):
    from tallycast.llm.language import fit_language

    rows = [(i, "the words of a common text", "en") for i in range(400)] + [(i, "sanat ovat harvinaisia", "fi") for i in range(400, 404)]
    assert fit_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=1, each=3).langs == ["en", "fi"]


def test_learning_ids_are_the_lowest_of_each_language(spark):
    """A language with nearly all rows, rare ones, one id for very many rows, ids with two languages."""
    from pyspark.sql import functions as F

    from tallycast.llm.language import learning_ids

    ids = spark.range(60_000, numPartitions=13)
    docs = ids.select(F.col("id").alias("doc_id"), F.expr("case when id % 500 = 0 then 'xx' when id % 4999 = 1 then 'yy' else 'aa' end").alias("lang"))
    docs = docs.unionAll(ids.select(F.lit(77).cast("long"), F.lit("zz"))).unionAll(ids.limit(40).selectExpr("id", "'aa'")).unionAll(ids.limit(9).selectExpr("id", "null"))
    found = {(r["doc_id"], r["lang"]) for r in learning_ids(docs, 4, 2, 300, 100).collect()}
    rows = docs.filter("lang is not null and crc32(cast(doc_id as string)) % 4 != 2").distinct().selectExpr("*", "xxhash64(doc_id) as h").collect()
    order = sorted(rows, key=lambda r: (r["h"], r["doc_id"], r["lang"]))
    want = {(r["doc_id"], r["lang"]) for r in order[:300]}
    for lang in {r["lang"] for r in rows}:
        want |= {(r["doc_id"], lang) for r in [r for r in order if r["lang"] == lang][:100]}
    assert found == want and {lang for _, lang in found} >= {"aa", "xx", "yy"}
    assert learning_ids(docs.limit(0), 4, 2, 300, 100).collect() == []
