"""Text steps: preparation, translation from a supplied table, sentiment, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.dates import day_of
from ..functions.text import clean_text, remove_stopwords
from ..session import write_out
from .shape import map_column

# ---- preparation and translation -------------------------------------------------


def prep_text(df: DataFrame, text: str = "text", out: str = "texto") -> DataFrame:
    """Cleaned text in place of the raw one: a projection, so no row is doubled."""
    cleaned = df.withColumn(out, clean_text(text))
    return cleaned if out == text else cleaned.drop(text)


def apply_translations(df: DataFrame, memory: DataFrame, text: str = "texto", out: str = "translation") -> DataFrame:
    """Translation of each text from a table (text, translation); null if missing.

    Joined on a hash, one row per text on the table side, so a text that very
    many rows share does not multiply; adaptive execution splits its rows.
    """
    side = memory.select(F.xxhash64("text").alias("_h"), F.col("text").alias("_t"), "translation").groupBy("_h", "_t").agg(
        F.min("translation").alias(out)
    )
    keyed = df.withColumn("_k", F.xxhash64(text))
    return keyed.join(side, (keyed._k == side._h) & (keyed[text] == side._t), "left").drop("_k", "_h", "_t")


def pending_translations(df: DataFrame, memory: DataFrame, text: str = "texto") -> DataFrame:
    """Each distinct text the table does not hold yet."""
    wanted = df.select(F.col(text).alias("text")).filter(F.col("text").isNotNull()).distinct()
    return wanted.join(memory.select("text"), "text", "left_anti")


# ---- sentiment ---------------------------------------------------------------------

# Fixed values of the published rule-based sentiment scorer (Hutto and Gilbert 2014).
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't", "can't", "couldn't",
    "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither", "don't",
    "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't", "neednt", "needn't", "never", "none", "nope", "nor",
    "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent", "oughtn't", "shan't",
    "shouldn't", "uh-uh", "wasn't", "weren't", "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom",
    "despite",
]
BOOSTERS_UP = [
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply", "effing", "enormously",
    "entirely", "especially", "exceptionally", "extremely", "fabulously", "flipping", "flippin", "fricking", "frickin",
    "frigging", "friggin", "fully", "fucking", "greatly", "hella", "highly", "hugely", "incredibly", "intensely",
    "majorly", "more", "most", "particularly", "purely", "quite", "really", "remarkably", "so", "substantially",
    "thoroughly", "totally", "tremendously", "uber", "unbelievably", "unusually", "utterly", "very",
]
BOOSTERS_DOWN = [
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof", "kind-of", "less", "little",
    "marginally", "occasionally", "partly", "scarcely", "slightly", "somewhat", "sort of", "sorta", "sortof", "sort-of",
]
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0,
    "kiss of death": -1.5, "hand to mouth": -2.0,
}
BOOST, CAPITALS, NEGATE, ALPHA = 0.293, 0.733, -0.74, 15.0
DISTANCE = (1.0, 0.95, 0.9)
EXCLAMATION, MAX_EXCLAMATIONS, QUESTION, MANY_QUESTIONS = 0.292, 4, 0.18, 0.96


def _is_capital(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _sign(v: Column, size: Column | float) -> Column:
    """``size`` towards the sign of ``v``; a value that is not positive counts as negative."""
    amount = F.lit(size) if isinstance(size, float) else size
    return F.when(v > 0, amount).otherwise(-amount)


# Fixed value: the ASCII punctuation that is removed at the ends of a word.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# A word of several characters, one upper case and none lower case, with the space before
# it: a text is given one in front, as looking behind each character takes three times as long.
_CAPITAL_WORD = r"\s(?:[^\s\p{Ll}\p{Lu}]+\p{Lu}[^\s\p{Ll}]*|\p{Lu}[^\s\p{Ll}]+)(?!\S)"


def sentiment_tokens(text: Column) -> Column:
    """Words longer than one character, punctuation still at their ends."""
    return F.regexp_extract_all(text, F.lit(r"\S{2,}"), F.lit(0))


def _bare(words: Column) -> Column:
    """Punctuation at the ends of each word removed, unless nothing would be left."""
    trimmed = F.transform(words, lambda w: F.btrim(w, F.lit(PUNCTUATION)))
    return F.zip_with(words, trimmed, lambda w, t: F.when(t == "", w).otherwise(t))


def score_sentiment(
    df: DataFrame, lexicon: DataFrame, key: str = "id", text: str = "translation",
    negations: Sequence[str] = NEGATIONS, boosters_up: Sequence[str] = BOOSTERS_UP,
    boosters_down: Sequence[str] = BOOSTERS_DOWN, idioms: Mapping[str, float] = IDIOMS,
) -> DataFrame:
    """neg, neu, pos and compound per ``key``, which must be unique in ``df``.

    A word with a valence in ``lexicon`` (token, valence) is changed by the
    three words before it: boosters, negation, "least", idioms and capitals;
    "but" halves what stands before it and lifts what follows; punctuation adds
    emphasis. Neighbours are read from the array of words, so no window over a
    text is needed: words without valence are dropped by the join with the lexicon
    before any shuffle, and what is left is summed on the map side. For that the
    lexicon is written first: its size is then known when the joins are planned,
    and up to Spark's broadcast threshold no word is shuffled for it. Every text
    also sends one empty row, so a text without any such word has scores too.
    """
    without = lambda c: F.length("_text") - F.length(F.replace(F.col("_text"), F.lit(c), F.lit("")))
    words = df.select(key, F.coalesce(F.col(text), F.lit("")).alias("_text")).select(
        key, sentiment_tokens(F.col("_text")).alias("_w"), F.regexp_count(F.concat(F.lit(" "), "_text"), F.lit(_CAPITAL_WORD)).alias("_caps"),
        without("!").alias("_marks"), without("?").alias("_asks"), F.lower("_text").contains("but").alias("_has_but"),
    )
    ask = F.when(F.col("_asks") <= 1, 0.0).when(F.col("_asks") <= 3, F.col("_asks") * QUESTION).otherwise(MANY_QUESTIONS)
    emphasis = F.least(F.col("_marks"), F.lit(MAX_EXCLAMATIONS)) * EXCLAMATION + ask
    but = F.array_position(F.transform("_b", F.lower), F.lit("but")) - 1
    # One element more than there are words: it makes the empty row of each text.
    bare = F.concat(_bare(F.col("_w")), F.array(F.lit(None).cast("string")))
    # Everything about the whole text is settled before the words are exploded, and
    # a word takes its neighbours out of the array before the join: Spark reads them
    # after it, for the words with a valence only.
    words = words.select("*", F.size("_w").alias("_n"), bare.alias("_b")).select(
        key, "_n", ((F.col("_caps") > 0) & (F.col("_caps") < F.col("_n"))).alias("_mixed"),
        F.when(F.col("_has_but"), but).alias("_but"), emphasis.alias("_emphasis"), "_b",
    )
    # Outer, as Spark else filters by the size of the array first and makes it twice.
    rows = words.select("*", F.posexplode_outer("_b").alias("i", "w"))
    at = F.when(F.col("w").isNotNull(), F.col("i"))
    near = [F.get("_b", at - k).alias(f"w{k}") for k in (1, 2, 3)] + [F.get("_b", at + k).alias(f"n{k}") for k in (1, 2)]
    rows = rows.select(key, "_n", "_mixed", "_but", "_emphasis", "i", "w", *near)

    lex = write_out(lexicon.groupBy(F.lower("token").alias("_token")).agg(F.max("valence").cast("double").alias("_valence")), "lexicon")

    def valence_of(frame: DataFrame, col: str, out: str) -> DataFrame:
        side = lex.select(F.col("_token").alias(f"_{col}"), F.col("_valence").alias(out))
        return frame.join(side, F.lower(F.col(col)) == F.col(f"_{col}"), "left").drop(f"_{col}")

    w = F.lower("w")
    is_booster = w.isin([*boosters_up, *boosters_down]) | ((w == "kind") & (F.lower("n1") == "of"))
    hits = valence_of(rows, "w", "v").filter(F.col("w").isNull() | (F.col("v").isNotNull() & ~F.coalesce(is_booster, F.lit(False))))
    for c in ("w1", "w2", "w3"):
        hits = valence_of(hits, c, f"{c}_v")
    # Spark keeps a lambda out of the code it makes. So the loop over all words ends
    # here, small enough to be compiled: the JVM leaves methods of over 8,000 bytes out.
    hits = hits.withColumn("_low", F.transform(F.array("w1", "w2", "w3"), F.lower))
    low = [F.get("_low", F.lit(k)) for k in range(3)]
    shout = F.col("_mixed") & _is_capital(F.col("w"))
    hits = hits.withColumn("v", F.when(shout, F.col("v") + _sign(F.col("v"), CAPITALS)).otherwise(F.col("v")))

    def negates(c: Column) -> Column:
        return c.isin(list(negations)) | c.contains("n't")

    so = lambda c: F.col(c).isin("so", "this")
    for k, c in enumerate(("w1", "w2", "w3")):
        here = F.col(c)
        # A neighbour counts unless it carries a valence of its own.
        counts = here.isNotNull() & F.col(f"{c}_v").isNull()
        v = F.col("v")
        size = F.when(low[k].isin(list(boosters_up)), F.lit(BOOST)).when(low[k].isin(list(boosters_down)), F.lit(-BOOST))
        toward = F.when(v < 0, -size).otherwise(size)
        loud = F.when(F.col("_mixed") & _is_capital(here), _sign(v, CAPITALS)).otherwise(0.0)
        hits = hits.withColumn("v", F.when(counts & size.isNotNull(), v + (toward + loud) * DISTANCE[k]).otherwise(v))
        v = F.col("v")
        if k == 0:
            turned = F.when(negates(low[k]), v * NEGATE)
        elif k == 1:
            turned = F.when((here == "never") & so("w1"), v * 1.5).when(negates(low[k]), v * NEGATE)
        else:
            turned = F.when(((here == "never") & so("w2")) | so("w1"), v * 1.25).when(negates(low[k]), v * NEGATE)
        hits = hits.withColumn("v", F.when(counts, F.coalesce(turned, v)).otherwise(v))
        if k == 2 and idioms:
            hits = hits.withColumn("v", F.when(counts, _idiom(F.col("v"), idioms, boosters_down, boosters_up)).otherwise(F.col("v")))

    least = (low[0] == "least") & F.col("w1_v").isNull() & ~F.coalesce(low[1].isin("at", "very"), F.lit(False))
    hits = hits.withColumn("v", F.when(least, F.col("v") * NEGATE).otherwise(F.col("v")))
    side = F.when(F.col("i") < F.col("_but"), 0.5).when(F.col("i") > F.col("_but"), 1.5).otherwise(1.0)
    hits = hits.withColumn("v", F.when(F.coalesce(F.col("_but"), F.lit(-1)) >= 0, F.col("v") * side).otherwise(F.col("v")))

    v = F.col("v")
    sums = hits.groupBy(key).agg(
        F.max("_n").alias("_n"), F.max("_emphasis").alias("_e"), F.coalesce(F.sum("v"), F.lit(0.0)).alias("_s"),
        F.coalesce(F.sum(F.when(v > 0, v + 1)), F.lit(0.0)).alias("_p"),
        F.coalesce(F.sum(F.when(v < 0, 1 - v)), F.lit(0.0)).alias("_m"),
        F.count_if(v != 0).alias("_hits"),
    )
    s, e = F.col("_s"), F.col("_e")
    total = F.when(s > 0, s + e).when(s < 0, s - e).otherwise(s)
    p = F.when(F.col("_p") > F.col("_m"), F.col("_p") + e).otherwise(F.col("_p"))
    m = F.when(F.col("_p") < F.col("_m"), F.col("_m") + e).otherwise(F.col("_m"))
    sums = sums.select(key, "_n", total.alias("_s"), p.alias("_p"), m.alias("_m"), (F.col("_n") - F.col("_hits")).alias("_z"))
    whole = F.col("_p") + F.col("_m") + F.col("_z")
    share = lambda c: F.coalesce(F.round(F.try_divide(c, whole), 3), F.lit(0.0))
    compound = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + ALPHA)))
    return sums.select(
        key, share(F.col("_m")).alias("neg"), share(F.col("_z").cast("double")).alias("neu"), share(F.col("_p")).alias("pos"),
        F.round(compound, 4).alias("compound"),
    )


def _idiom(v: Column, idioms: Mapping[str, float], down: Sequence[str], up: Sequence[str]) -> Column:
    """Value of the first fixed phrase around the word, then the two-word boosters before it."""
    text = lambda *c: F.concat_ws(" ", *c)
    before = [text("w1", "w"), text("w2", "w1", "w"), text("w2", "w1"), text("w3", "w2", "w1"), text("w3", "w2")]
    after = [(F.col("n1"), text("w", "n1")), (F.col("n2"), text("w", "n1", "n2"))]

    values = F.create_map(*[F.lit(x) for k, v in idioms.items() for x in (k, float(v))])

    def value(phrase: Column) -> Column:
        return F.try_element_at(values, phrase)

    v = F.coalesce(F.get(F.array_compact(F.transform(F.array(*before), value)), F.lit(0)), v)
    for present, phrase in after:
        v = F.coalesce(F.when(present.isNotNull(), value(phrase)), v)
    pairs = [b for b in [*down, *up] if " " in b]
    two = text("w3", "w2").isin(pairs) | text("w2", "w1").isin(pairs) if pairs else F.lit(False)
    return F.when(two, v - BOOST).otherwise(v)


# ---- export -------------------------------------------------------------------------


def export_columns(stopwords: Sequence[str], country: str = "country", text: str = "texto", date: str = "date") -> list[Column]:
    """Columns of the export that need no scores: day, country id, text without stop words."""
    return [
        day_of(date).alias("date"), map_column(country, C.CODE_IDS, "int").alias("country"),
        remove_stopwords(text, stopwords).alias("texto"),
    ]


def tweet_gold(df: DataFrame, stopwords: Sequence[str], country: str = "country", text: str = "texto", date: str = "date") -> DataFrame:
    """Export shape: day, country id, text without stop words, scores."""
    return df.select(*export_columns(stopwords, country, text, date), "neg", "neu", "pos", "compound")
