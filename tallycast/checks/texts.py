"""Text steps over whole documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text, remove_stopwords
from ..operators import texts as T
from ..plans.tweets import tweets_daily
from ..session import spread_scan
from .joined import _TWEETS, stored_pages
from .registry import query, table

# Spanish function words that the documents hold; any list can be given.
STOPWORDS = ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "por", "un", "no", "con", "su", "una", "para", "es", "al", "lo"]
_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"
_CLEAN = "regexp_replace(lower({0}), '[^A-Za-z0-9À-ÿ\\- @#]', '', 'g')"


def _without_stopwords(c: str) -> str:
    kept = f"[w for w in string_split(lower({c}), ' ') if NOT list_contains({_STOP_SQL}, w)]"
    return f"replace(replace(array_to_string({kept}, ' '), 'covid', ''), '19', '')"


def documents(spark, sf):
    return spread_scan(table(spark, sf, "documents"), "doc_id")


@query("clean_text", f"SELECT doc_id, md5({_CLEAN.format('text')}) AS texto FROM documents")
def clean(spark, sf):
    return documents(spark, sf).select("doc_id", F.md5(clean_text("text")).alias("texto"))


@query("stopwords", f"SELECT doc_id, md5({_without_stopwords('text')}) AS texto FROM documents")
def stopwords(spark, sf):
    return documents(spark, sf).select("doc_id", F.md5(remove_stopwords("text", STOPWORDS)).alias("texto"))


@query("prep_text", f"SELECT doc_id, lang, md5({_CLEAN.format('text')}) AS texto FROM documents")
def prep_text(spark, sf):
    d = T.prep_text(documents(spark, sf).select("doc_id", "lang", "text"))
    return d.withColumn("texto", F.md5("texto"))


# ---- translations -------------------------------------------------------------------


def _memory(spark, sf):
    """Translations known so far: every text of two languages."""
    d = documents(spark, sf).filter(F.col("lang").isin("en", "es"))
    return d.select("text", F.concat(F.lit("en: "), F.col("text")).alias("translation"))


@query("translations", """
SELECT doc_id, CASE WHEN text IN (SELECT text FROM documents WHERE lang IN ('en', 'es')) THEN md5('en: ' || text) END AS translation FROM documents""")
def translations(spark, sf):
    d = T.apply_translations(documents(spark, sf).select("doc_id", F.col("text").alias("texto")), _memory(spark, sf))
    return d.select("doc_id", F.md5("translation").alias("translation"))


@query("pending_translations", """
SELECT DISTINCT md5(text) AS text FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE lang IN ('en', 'es'))""")
def pending(spark, sf):
    d = T.pending_translations(documents(spark, sf).select(F.col("text").alias("texto")), _memory(spark, sf))
    return d.select(F.md5("text").alias("text"))


# ---- sentiment ----------------------------------------------------------------------

# A small lexicon and word lists of words that the tables hold, so that every
# rule is met; a user gives the published ones.
LEXICON = [
    ("with", 1.2), ("for", 0.8), ("was", -0.9), ("by", -1.3), ("les", 1.1), ("la", 0.7), ("der", -0.6), ("que", 1.9), ("los", -1.7),
    ("nicht", -2.0), ("is", 2.4), ("sich", 1.5), ("th", -0.3), ("of", 0.4),
]
UP, DOWN, NO = ["the", "die", "el"], ["to", "en"], ["and", "et", "und", "y", "no"]
PHRASES = {"that is": 2.5, "in la": -1.5, "is that": 1.4, "by on the": -2.2}


def sentiment_sql(base: str, key: str, up=UP, down=DOWN, no=NO, phrases=PHRASES) -> str:
    """The scoring rules as SQL over ``base`` (key, text)."""
    _in = lambda words: "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"
    pairs = [w for w in [*down, *up] if " " in w]
    two = f"concat_ws(' ', w3, w2) IN {_in(pairs)} OR concat_ws(' ', w2, w1) IN {_in(pairs)}" if pairs else "false"
    strip = "regexp_replace(w, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')"
    capital = lambda w: f"({w} = upper({w}) AND {w} <> lower({w}))"
    phrase = lambda c: "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in phrases.items()) + " END"
    steps = []
    for k, (w, damp) in enumerate((("w1", 1.0), ("w2", 0.95), ("w3", 0.9))):
        before = "e0" if k == 0 else f"n{k - 1}"
        counts = f"{w} IS NOT NULL AND {w}v IS NULL"
        size = f"(CASE WHEN lower({w}) IN {_in(up)} THEN 0.293 ELSE -0.293 END)::DOUBLE"
        loud = f"CASE WHEN mixed AND {capital(w)} THEN CASE WHEN v > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END::DOUBLE"
        steps.append(
            f"b{k} AS (SELECT * REPLACE (CASE WHEN {counts} AND lower({w}) IN {_in([*up, *down])} THEN v + "
            f"((CASE WHEN v < 0 THEN -{size} ELSE {size} END) + {loud}) * {damp}::DOUBLE ELSE v END AS v) FROM {before})"
        )
        negate = f"WHEN lower({w}) IN {_in(no)} OR contains(lower({w}), 'n''t') THEN v * -0.74::DOUBLE"
        if k == 1:
            negate = f"WHEN w2 = 'never' AND w1 IN ('so', 'this') THEN v * 1.5 {negate}"
        if k == 2:
            negate = f"WHEN (w3 = 'never' AND w2 IN ('so', 'this')) OR w1 IN ('so', 'this') THEN v * 1.25 {negate}"
        steps.append(f"n{k} AS (SELECT * REPLACE (CASE WHEN NOT ({counts}) THEN v {negate} ELSE v END AS v) FROM b{k})")
    first = ", ".join(phrase(c) for c in (
        "concat_ws(' ', w1, w)", "concat_ws(' ', w2, w1, w)", "concat_ws(' ', w2, w1)", "concat_ws(' ', w3, w2, w1)", "concat_ws(' ', w3, w2)"))
    return f"""
WITH {base},
q AS (SELECT {key}, coalesce(text, '') AS text,
  [CASE WHEN {strip} = '' THEN w ELSE {strip} END for w in string_split_regex(trim(text, ' '), '[ \\t\\n\\v\\f\\r]+') if length(w) > 1] AS ws FROM base),
a AS (SELECT {key}, len(ws) AS n, ws, len([1 for w in ws if {capital('w')}]) AS caps, list_position([lower(w) for w in ws], 'but') - 1 AS but,
  least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE + CASE WHEN length(text) - length(replace(text, '?', '')) <= 1 THEN 0
  WHEN length(text) - length(replace(text, '?', '')) <= 3 THEN (length(text) - length(replace(text, '?', ''))) * 0.18::DOUBLE ELSE 0.96 END AS emphasis FROM q),
u AS (SELECT {key}, n, caps > 0 AND caps < n AS mixed, but, emphasis, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM a),
l AS (SELECT * FROM (VALUES {', '.join(f"('{t}', {v}::DOUBLE)" for t, v in LEXICON)}) x(t, val)),
c AS (SELECT u.*, lag(w, 1) OVER o AS w1, lag(w, 2) OVER o AS w2, lag(w, 3) OVER o AS w3, lead(w, 1) OVER o AS f1, lead(w, 2) OVER o AS f2
  FROM u WINDOW o AS (PARTITION BY {key} ORDER BY i)),
e AS (SELECT c.*, l.val AS v, l1.t AS w1v, l2.t AS w2v, l3.t AS w3v FROM c JOIN l ON l.t = lower(w) LEFT JOIN l l1 ON l1.t = lower(w1)
  LEFT JOIN l l2 ON l2.t = lower(w2) LEFT JOIN l l3 ON l3.t = lower(w3) WHERE lower(w) NOT IN {_in([*up, *down])}
  AND NOT (lower(w) = 'kind' AND coalesce(lower(f1), '') = 'of')),
e0 AS (SELECT * REPLACE (CASE WHEN mixed AND {capital('w')} THEN CASE WHEN v > 0 THEN v + 0.733 ELSE v - 0.733 END ELSE v END AS v) FROM e),
{', '.join(steps)},
p AS (SELECT * REPLACE (CASE WHEN w3 IS NOT NULL AND w3v IS NULL THEN coalesce({first}, v) ELSE v END AS v) FROM n2),
p1 AS (SELECT * REPLACE (CASE WHEN w3 IS NOT NULL AND w3v IS NULL AND f1 IS NOT NULL THEN coalesce({phrase("concat_ws(' ', w, f1)")}, v) ELSE v END AS v) FROM p),
p2 AS (SELECT * REPLACE (CASE WHEN w3 IS NOT NULL AND w3v IS NULL AND f2 IS NOT NULL THEN coalesce({phrase("concat_ws(' ', w, f1, f2)")}, v) ELSE v END AS v) FROM p1),
p3 AS (SELECT * REPLACE (CASE WHEN w3 IS NOT NULL AND w3v IS NULL AND ({two}) THEN v - 0.293 ELSE v END AS v) FROM p2),
x AS (SELECT * REPLACE (CASE WHEN lower(w1) = 'least' AND w1v IS NULL AND coalesce(lower(w2), '') NOT IN ('at', 'very') THEN v * -0.74::DOUBLE ELSE v END AS v) FROM p3),
y AS (SELECT * REPLACE (CASE WHEN but IS NULL THEN v WHEN i < but THEN v * 0.5 WHEN i > but THEN v * 1.5 ELSE v END AS v) FROM x),
g AS (SELECT a.{key}, a.n, a.emphasis, coalesce(sum(v), 0) AS s, coalesce(sum(v + 1) FILTER (v > 0), 0) AS p, coalesce(sum(1 - v) FILTER (v < 0), 0) AS m,
  count(*) FILTER (v <> 0) AS h FROM a LEFT JOIN y ON y.{key} = a.{key} GROUP BY a.{key}, a.n, a.emphasis),
h AS (SELECT {key}, CASE WHEN s > 0 THEN s + emphasis WHEN s < 0 THEN s - emphasis ELSE s END AS s,
  CASE WHEN p > m THEN p + emphasis ELSE p END AS p, CASE WHEN m > p THEN m + emphasis ELSE m END AS m, CAST(n - h AS DOUBLE) AS z FROM g),
sent AS (SELECT {key}, CASE WHEN p + m + z = 0 THEN 0.0 ELSE round(m / (p + m + z), 3) END AS neg, CASE WHEN p + m + z = 0 THEN 0.0 ELSE round(z / (p + m + z), 3) END AS neu,
  CASE WHEN p + m + z = 0 THEN 0.0 ELSE round(p / (p + m + z), 3) END AS pos, round(s / sqrt(s * s + 15), 4) AS compound FROM h)"""


def _lexicon(spark):
    return spark.createDataFrame(LEXICON, "token string, valence double")


def _score(df, spark, key):
    return T.score_sentiment(df, _lexicon(spark), key, negations=NO, boosters_up=UP, boosters_down=DOWN, idioms=PHRASES)


@query("sentiment", sentiment_sql("base AS (SELECT doc_id, text FROM documents)", "doc_id") + " SELECT * FROM sent")
def sentiment(spark, sf):
    """Raw documents, so that capitals and punctuation count too."""
    return _score(documents(spark, sf).select("doc_id", F.col("text").alias("translation")), spark, "doc_id")


# Words of the documents and the words of the published lists that take their
# places, so that each sort of rule is met.
PLACED = {
    " the ": " very ", " to ": " slightly ", " and ": " not ", " that ": " kind of ", " er ": " never ", " thon ": " so ",
    " in ": " isn't ", " on ": " without ", " are ": " the bomb ", " be ": " sort of ", " de ": " absolutely ", " le ": " yeah right ",
}


def _placed_sql(c: str) -> str:
    for old, new in PLACED.items():
        c = f"replace({c}, '{old}', '" + new.replace("'", "''") + "')"
    return c


@query("sentiment_published", sentiment_sql(
    f"base AS (SELECT doc_id, {_placed_sql('text')} AS text FROM documents)", "doc_id", T.BOOSTERS_UP, T.BOOSTERS_DOWN, T.NEGATIONS, T.IDIOMS
) + " SELECT * FROM sent")
def sentiment_published(spark, sf):
    """The word lists that a user gets by default."""
    text = F.col("text")
    for old, new in PLACED.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return T.score_sentiment(documents(spark, sf).select("doc_id", text.alias("translation")), _lexicon(spark), "doc_id")


@query("tweet_gold", sentiment_sql("base AS (SELECT doc_id, text FROM documents)", "doc_id") + f"""
SELECT CAST('2022-01-01' AS DATE) + CAST(d.doc_id % 365 AS INT) AS date, CASE lang WHEN 'es' THEN 4 WHEN 'en' THEN 1 WHEN 'de' THEN 5 ELSE 2 END AS country,
  md5({_without_stopwords(_CLEAN.format('d.text'))}) AS texto, neg, neu, pos, compound
FROM documents d JOIN sent ON sent.doc_id = d.doc_id""")
def tweet_gold(spark, sf):
    """The text is cleaned and hashed before the join with its scores, so that no whole text is shuffled."""
    rows = documents(spark, sf).select(
        "doc_id", clean_text("text").alias("texto"),
        F.concat(F.date_add(F.lit("2022-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).cast("string"), F.lit("T10:00:00.000Z")).alias("date"),
        F.when(F.col("lang") == "es", "ES").when(F.col("lang") == "en", "AR").when(F.col("lang") == "de", "MX").otherwise("CL").alias("country"),
    )
    short = rows.select("doc_id", *T.export_columns(STOPWORDS)).withColumn("texto", F.md5("texto"))
    return short.join(sentiment(spark, sf), "doc_id").drop("doc_id")


@query("tweets_daily", sentiment_sql(f"{_TWEETS}, base AS (SELECT created_at, location, text AS raw, {_CLEAN.format('text')} AS text, "
                                     "created_at || location || text AS k FROM t WHERE created_at < '2024-01-20')", "k") + f"""
SELECT CAST(left(b.created_at, 10) AS DATE) AS date, CAST(4 AS INT) AS country, md5({_without_stopwords('b.text')}) AS texto, neg, neu, pos, compound
FROM base b JOIN sent ON sent.k = b.k""")
def tweets(spark, sf):
    """Stored pages to export rows: explode, join, clean, translate, score. The
    translation table gives every cleaned text back as it is."""
    c = table(spark, sf, "conversations").select(clean_text("text").alias("text")).distinct()
    memory = c.withColumn("translation", F.col("text"))
    rules = {"negations": NO, "boosters_up": UP, "boosters_down": DOWN, "idioms": PHRASES}
    gold = tweets_daily(spark, stored_pages(spark, sf), "ES", memory, _lexicon(spark), STOPWORDS, "2024-01-20", **rules)
    return gold.withColumn("texto", F.md5("texto"))
