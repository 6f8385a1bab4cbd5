"""The corpus pipeline: each stage against what it must do to its own input."""

import corpus_pipeline as pipeline
import pytest
from conftest import SF

from tallycast.llm.queries import ORACLES, QUERIES
from tallycast.llm.toxicity import fit_toxicity, with_toxicity
from tallycast.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs.count()
        if name == "toxicity":
            model = fit_toxicity(before, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r["doc_id"] for r in with_toxicity(before, model, "p").filter("p < 0.3").collect()}
            assert {r["doc_id"] for r in docs.collect()} == want
        if name != "packing":
            assert docs.columns == COLUMNS
        if name == "substring_dedup":
            assert docs.filter("n_chars <> length(text)").count() == 0 or docs.join(before, ["doc_id", "text"]).count() > 0
    assert list(kept) == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]
    assert kept["toxicity"] < 200 and kept["near_dedup"] < kept["toxicity"] and kept["decontamination"] < kept["substring_dedup"]
    assert {r["doc_id"] for r in pipeline.run(spark, SF).select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}


@pytest.fixture
def plain(spark):
    return lambda rows: spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_on_odd_rows(spark, plain):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, "no id"), (None, "no id"), (1, None), (2, ""), (3, "a few words"), (3, "a few words"), (4, "a few words"), (5, f"start {passage} end"), (6, f"other {passage} place")]
    near = pipeline.near_dedup(spark, plain(rows), SF).collect()
    assert sorted((r["doc_id"] for r in near), key=repr) == sorted([None, None, 1, 3, 5], key=repr)  # 6 is a near copy of 5
    cut = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pipeline.substring_dedup(spark, plain(rows[5:]), SF).collect()}
    assert cut == {3: ("a few words", 11), 4: ("a few words", 11), 5: ("start end", 9), 6: ("other place", 11)}
    assert pipeline.substring_dedup(spark, plain([(1, passage), (2, passage)]), SF).collect() == []
    for _, stage in pipeline.STAGES:
        assert stage(spark, plain([]), SF).collect() == []
        assert stage(spark, plain(rows), SF).count() > 0


def test_an_id_of_two_texts_joins_nothing(spark, plain):
    rows = [(1, "one clean text"), (2, "one clean text"), (2, "quite another thing"), (3, "quite another thing"), (3, "quite another thing")]
    near = pipeline.near_dedup(spark, plain(rows), SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in near) == [(1, "one clean text"), (2, "quite another thing")]


def test_registered():
    import __spark_entry__ as entry

    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
