import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key long, g string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang]) rows, with extra columns whose names operators use themselves."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or ""), 0.5, 7, "x") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def labels(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, y int")

    return build
