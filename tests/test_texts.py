import pytest

from tallycast.checks import QUERIES
from tallycast.functions.text import clean_text, remove_stopwords
from tallycast.operators import sinks
from tallycast.operators import texts as T
from tallycast.operators.joins import join_tweet_user
from tallycast.plans.tweets import tweets_daily
from tallycast.sources.html import extract_html_table
from tallycast.sources.pages import PAGE_SCHEMA, incomplete_chains, read_pages, tweets_of, users_of

# Valences of the published lexicon for the words used here.
LEXICON = [("good", 1.9), ("great", 3.1), ("bad", -2.5), ("smart", 1.7), ("handsome", 2.2), ("funny", 1.9), ("horrible", -2.5), ("kind", 2.4), ("sux", -1.5)]

# Published scores of the rule-based scorer for its own example sentences.
KNOWN = [
    ("VADER is smart, handsome, and funny.", 0.0, 0.254, 0.746, 0.8316),
    ("VADER is smart, handsome, and funny!", 0.0, 0.248, 0.752, 0.8439),
    ("VADER is very smart, handsome, and funny.", 0.0, 0.299, 0.701, 0.8545),
    ("VADER is VERY SMART, handsome, and FUNNY.", 0.0, 0.246, 0.754, 0.9227),
    ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.0, 0.233, 0.767, 0.9342),
    ("The book was good.", 0.0, 0.508, 0.492, 0.4404),
    ("The book was kind of good.", 0.0, 0.657, 0.343, 0.3832),
    ("not good", 0.706, 0.294, 0.0, -0.3412),
    ("", 0.0, 0.0, 0.0, 0.0),
    ("nothing to see here", 0.0, 1.0, 0.0, 0.0),
]


def test_known_scores(spark):
    lex = spark.createDataFrame(LEXICON, "token string, valence double")
    df = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(KNOWN)], "id int, translation string")
    found = {r.id: (r.neg, r.neu, r.pos, r.compound) for r in T.score_sentiment(df, lex).collect()}
    for i, (text, *want) in enumerate(KNOWN):
        assert found[i] == pytest.approx(tuple(want), abs=6e-4), text


def test_but_and_negation_order(spark):
    lex = spark.createDataFrame(LEXICON, "token string, valence double")
    texts = ["the plot was good but the characters are bad", "never so good", "at least it is good", "least good", "no one said it was not very good"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, translation string")
    found = {r.id: r.compound for r in T.score_sentiment(df, lex).collect()}

    def norm(s):
        return round(s / (s * s + 15) ** 0.5, 4)

    assert found[0] == norm(1.9 * 0.5 - 2.5 * 1.5)
    # "so" strengthens first, then "never so" counts.
    assert found[1] == pytest.approx(norm((1.9 + 0.293) * 1.5), abs=1e-4)
    assert found[2] == norm(1.9)
    assert found[3] == norm(1.9 * -0.74)
    assert found[4] == norm((1.9 + 0.293) * -0.74)


def test_clean_text(spark):
    df = spark.createDataFrame([("OlÁ @foo #COVID-19, 世! naïve_x",)], "t string")
    assert df.select(clean_text("t")).first()[0] == "olá @foo #covid-19  naïvex"


def test_stop_words(spark):
    df = spark.createDataFrame([("La covid19 EN  2019 y más",)], "t string")
    assert df.select(remove_stopwords("t", ["la", "en", "y"])).first()[0] == "  20 más"
    assert df.select(remove_stopwords("t", [])).first()[0] == "la  en  20 y más"


def page(tweets, users, token=None):
    return (
        [{"author_id": a, "created_at": c, "text": t} for a, c, t in tweets],
        {"users": [{"id": i, "location": x} for i, x in users]}, {"next_token": token},
    )


def test_tweets_are_not_doubled(spark):
    second = "2022-05-01T10:00:00.000Z"
    pages = spark.createDataFrame([
        page([("1", second, "uno"), ("1", second, "dos")], [("1", "Quito")], "x"),
        page([("1", second, "uno"), ("9", second, "sin")], [("1", "Quito")]),
    ], PAGE_SCHEMA)
    out = join_tweet_user(tweets_of(pages), users_of(pages))
    assert sorted(r.text for r in out.collect()) == ["dos", "uno"]
    memory = spark.createDataFrame([("uno", "one good"), ("dos", "two bad")], "text string, translation string")
    lex = spark.createDataFrame(LEXICON, "token string, valence double")
    gold = tweets_daily(spark, pages, "CL", memory, lex, ["dos"]).collect()
    assert {(r.texto, r.country, str(r.date)) for r in gold} == {("uno", 2, "2022-05-01"), ("", 2, "2022-05-01")}
    assert {r.texto: r.compound > 0 for r in gold} == {"uno": True, "": False}


def test_missing_translation_has_no_score(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "texto string")
    memory = spark.createDataFrame([("a", "x")], "text string, translation string")
    assert sorted(r.translation or "" for r in T.apply_translations(df, memory).collect()) == ["", "", "", "x"]
    assert [r.text for r in T.pending_translations(df, memory).collect()] == ["b"]


def test_chains_by_file(spark, tmp_path):
    (tmp_path / "whole.json").write_text('{"data":[],"meta":{"next_token":"a"}}\n{"data":[],"meta":{}}\n')
    (tmp_path / "cut.json").write_text('{"data":[],"meta":{"next_token":"a"}}\n')
    bad = incomplete_chains(read_pages(spark, str(tmp_path))).collect()
    assert len(bad) == 1 and bad[0].chain.endswith("cut.json") and (bad[0].pages, bad[0].last_pages) == (1, 0)


def test_snapshot_files(spark, tmp_path):
    from tallycast.constants import SNAPSHOT_NUMBERS
    from tallycast.plans import snapshot_gold
    from tallycast.sources import read_snapshots

    head = ",".join(f'"{c}"' for c in ["Country", "Date", *SNAPSHOT_NUMBERS])
    blank = "," * (len(SNAPSHOT_NUMBERS) - 4)
    for day in ("2022-05-01", "2022-05-02"):
        lines = [head, f'Spain,{day},"1,000",10,+2,5{blank}', f"France,{day},9,9,9,9{blank}", f'Spain,{day},"1,000",10,+2,5{blank}']
        (tmp_path / f"data_{day}.csv").write_text("\n".join(lines) + "\n")
    out = snapshot_gold(read_snapshots(spark, str(tmp_path / "*.csv"))).orderBy("Date").collect()
    assert [(r.Country, r.Date, r.NewCases, r.Mortality, r.NewDeaths) for r in out] == [
        (4, "2022-05-01", 2.0, 0.005, 0.0), (4, "2022-05-02", 2.0, 0.005, 0.0)
    ]


def test_html_variants(spark):
    html = """<TABLE><THEAD><tr><th>A</th><th>B &amp; C</th></tr></THEAD><TBODY>
    <tr><td>1</td><td><a href='x'>two</a></td></tr><tr><th>3</th></tr></TBODY></TABLE>"""
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id int, html string")
    rows = extract_html_table(df).orderBy("row_pos").collect()
    assert [(r.page_id, r.header, r.cells) for r in rows] == [(1, ["A", "B & C"], ["1", "two"]), (1, ["A", "B & C"], ["3"])]


def odd_pages(spark, before, after):
    """A page twice, and pages that are null, empty, without a table, with few rows, with rows of few cells, without an end tag."""
    row = "<tr><td>{0}</td>\n<td><b>&lt;{0}</b></td></tr>"
    rows = ["".join(row.format(i) for i in range(n)) for n in (5, 5, 2, 1, 0)]
    texts = [*(before + x + after for x in rows), None, "", "<p>none</p>", before + "<tr></tr><TR class='r'><td>7</td><tr><td>8</td></TR ><tr></tr>" + after, before + row]
    return spark.createDataFrame([(min(i, 1) if i < 2 else i, x) for i, x in enumerate(texts)], "page_id int, html string").replace({0: None})


def test_pages_are_read_once(spark):
    """Pages are not searched for their rows by a filter before the rows are exploded."""
    pages = odd_pages(spark, "<table><thead><tr><th>A</th><th> B </th></tr></thead><tbody>", "</tbody></table>")
    table = extract_html_table(pages, head=1, tail=1)
    assert not [x for x in table._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "regexp" in x]
    got = sorted(((r.page_id, r.row_pos, r.header, r.cells) for r in table.collect()), key=repr)
    full = [(i, n - 1, ["A", " B "], [f"{n}", f"<{n}"]) for i in (None, 1) for n in (1, 2, 3)]
    assert got == sorted([*full, (8, 0, ["A", " B "], ["7", "8"])], key=repr)
    assert extract_html_table(pages.filter("page_id > 3"), head=0).filter("row_pos is null").count() == 0
    assert extract_html_table(pages.filter("page_id > 8 or page_id in (4, 5, 6, 7)")).count() == 0


def test_rows_of_a_classed_table_are_read_once(spark):
    """Header and body come from one search of the page."""
    pages = odd_pages(spark, "<table class='t'><tr><td>no</td></tr></table><table class=\"u t\"><tr><th>A</th><th> B </th></tr>", "</table>")
    table = extract_html_table(pages, css_class="t", nth=1, head=1, tail=1)
    assert table._jdf.queryExecution().optimizedPlan().toString().count("<table") == 1
    got = sorted(((r.page_id, r.row_pos, r.header, r.cells) for r in table.collect()), key=repr)
    full = [(i, n - 1, ["A", " B "], [f"{n}", f"<{n}"]) for i in (None, 1) for n in (1, 2, 3)]
    assert got == sorted([*full, (8, 0, ["A", " B "], ["7", "8"])], key=repr)
    assert [(r.page_id, r.header, r.cells) for r in extract_html_table(pages, css_class="t", nth=-1).filter("page_id in (3, 4, 9)").collect()] == [
        (3, ["A", " B "], ["0", "<0"])
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_word_is_shuffled(spark):
    """The only shuffle is that of the sums of each text; the lexicon goes to the words."""
    lex = spark.createDataFrame(LEXICON, "token string, valence double")
    df = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(KNOWN)], "id int, translation string")
    plan = plan_of(T.score_sentiment(df, lex))
    assert "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_end_of_text_takes_no_value(spark):
    """Words at the end of a text count once, also where they are a fixed phrase; lone punctuation stays a word."""
    lex = spark.createDataFrame(LEXICON, "token string, valence double")
    texts = ["so good he is the bomb", "he is the bomb", "good --", "-- !! good", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, translation string")
    found = {r.id: (r.neu, r.pos) for r in T.score_sentiment(df, lex).collect()}
    assert found[1] == (1.0, 0.0) and found[4] == (0.0, 0.0)
    # Words without a valence count 1 each, one of valence v counts 1 + v.
    assert found[0] == (pytest.approx(5 / (5 + 2.9 + 0.293), abs=6e-4), pytest.approx((2.9 + 0.293) / (5 + 2.9 + 0.293), abs=6e-4))
    assert found[2][0] == pytest.approx(1 / (1 + 2.9), abs=6e-4)
    assert found[3][0] == pytest.approx(2 / (2 + 2.9 + 2 * 0.292), abs=6e-4)


def joined_columns(node):
    """Names of all columns that any join of a plan takes in."""
    kids = [node.children().apply(i) for i in range(node.children().size())]
    own = {k.output().apply(i).name() for k in kids for i in range(k.output().size())} if node.nodeName() == "Join" else set()
    return own.union(*map(joined_columns, kids))


@pytest.fixture
def texts_dir(spark, tmp_path):
    """Documents of which one id comes twice, one is null and one text is null."""
    rows = [(1, "is it the AND is", "en"), (2, "la que los", "es"), (2, "is", "fr"), (None, "is", "en"), (3, None, "de")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_export_joins_no_text(spark, texts_dir):
    df = QUERIES["tweet_gold"](spark, texts_dir)
    assert df.columns == ["date", "country", "texto", "neg", "neu", "pos", "compound"]
    assert not joined_columns(df._jdf.queryExecution().optimizedPlan()) & {"text", "_text", "_b"}
    scores = {r.doc_id: r.compound for r in QUERIES["sentiment"](spark, texts_dir).collect()}
    found = sorted((r.date.day, r.country, r.texto is None, r.compound) for r in df.collect())
    assert found == [(2, 1, False, scores[1]), (3, 2, False, scores[2]), (3, 4, False, scores[2]), (4, 5, True, scores[3])]


def test_published_lists_shuffle_no_word(spark, texts_dir):
    plan = plan_of(QUERIES["sentiment_published"](spark, texts_dir))
    assert "SortMergeJoin" not in plan
    # The one that spreads a small file over the cores; the sums lie as it dealt the ids.
    assert plan.count("Exchange hashpartitioning") == 1


def test_load_of_scores_joins_no_text(spark, texts_dir, monkeypatch):
    loaded, load = [], sinks.load_gold
    monkeypatch.setattr(sinks, "load_gold", lambda df, *more: (loaded.append(df), load(df, *more)))
    fact = QUERIES["load_sentiments"](spark, texts_dir)
    assert not joined_columns(loaded[0]._jdf.queryExecution().optimizedPlan()) & {"text", "_text", "_b"}
    # A text that is null has no row; the id that comes twice has its scores in both.
    assert sorted((r.PAISES_ID, r.CALENDARIO_data.day) for r in fact.collect()) == [(1, 2), (2, 3), (4, 3)]
    assert len({r.composto for r in fact.collect() if r.CALENDARIO_data.day == 3}) == 1
