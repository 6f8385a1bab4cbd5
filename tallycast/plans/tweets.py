"""Stored tweet pages to scored export rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import join_tweet_user
from ..operators.shape import before, with_country
from ..operators.sinks import with_id
from ..operators.texts import apply_translations, prep_text, score_sentiment, tweet_gold
from ..session import write_out
from ..sources.pages import read_pages, tweets_of, users_of


def score_tweets(tweets: DataFrame, memory: DataFrame, lexicon: DataFrame, **rules) -> DataFrame:
    """created_at, text and location with cleaned text, translation and scores.

    A text the translation table does not hold has no scores, as it is not
    English yet; it is listed by ``pending_translations``.
    """
    rows = with_id(tweets, ["created_at", "text", "location"], "row_id")
    # Written once: the scores are made from these rows and joined to them again.
    rows = write_out(apply_translations(prep_text(rows), memory), "tweets")
    scores = score_sentiment(rows.filter(rows.translation.isNotNull()).select("row_id", "translation"), lexicon, "row_id", **rules)
    return rows.join(scores, "row_id", "left").withColumnRenamed("created_at", "date")


def tweets_daily(
    spark: SparkSession, src: str | DataFrame, country: str, memory: DataFrame, lexicon: DataFrame,
    stopwords: Sequence[str], limit: str | None = None, **rules,
) -> DataFrame:
    """Pages of one country to the rows of its export; ``rules`` go to the scorer."""
    pages = read_pages(spark, src) if isinstance(src, str) else src
    tweets = tweets_of(pages)
    if limit is not None:
        tweets = before(tweets, limit)
    scored = score_tweets(join_tweet_user(tweets, users_of(pages)), memory, lexicon, **rules)
    return tweet_gold(with_country(scored, country), stopwords)
