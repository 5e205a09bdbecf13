"""Shared inputs of the registered queries: the driver tables read through
the adapters, and the derived stage outputs most queries start from.

Each function takes (spark, sf_dir) and returns a lazy DataFrame; nothing is
collected.  The as-of time of every window is the newest row of the data it
filters (a scalar subquery), never the wall clock.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.lineage import gather, materialize, spread
from quire.functions.windows import as_of_literal, latest
from quire.operators import prepare, segment, tfidf, tokens
from quire.sources import adapters
from quire.sources.tables import read_table


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return adapters.news_from_documents(docs)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_articles(news(spark, sf_dir))


def redelivered_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_articles(adapters.redelivered(news(spark, sf_dir)))


def news_as_of(spark: SparkSession, sf_dir: str):
    return latest(news(spark, sf_dir), "time")


def as_of_value(spark: SparkSession, sf_dir: str):
    """The newest publish time as a literal, so that window bounds are constants
    in the plan (one aggregate over the id column, a single value)."""
    newest = news(spark, sf_dir).select("time").agg(F.max("time")).first()[0]
    return F.lit(None).cast("timestamp_ntz") if newest is None else as_of_literal(newest)


def article_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    # spread the raw rows, so cleaning and concatenation also run in parallel
    arts = prepare.prepare_articles(spread(news(spark, sf_dir), "m_id"))
    return tokens.tokenize(arts.select("article_id", "sentence"))


@dataclass
class KeywordStage:
    articles: DataFrame
    tf: DataFrame  # (article_id, word, tf), materialized
    vocabulary: DataFrame  # (keyword, count, df, idf, index), materialized
    top: DataFrame  # (article_id, keyword, index, tfidf, rank)
    keywords: DataFrame  # top joined with the article's channel and time


def keyword_stage(spark: SparkSession, sf_dir: str) -> KeywordStage:
    """Tokens -> term frequencies (materialized once) -> vocabulary + idf ->
    top-20 keywords per article."""
    arts = articles(spark, sf_dir)
    # the texts are shuffled, not their words
    gathered = prepare.prepare_articles(gather(news(spark, sf_dir), "m_id"))
    toks = tokens.tokenize(gathered.select("article_id", "sentence"))
    tf = materialize(tfidf.term_frequency(toks))
    vocab = tfidf.fit_vocabulary(tf, tfidf.document_count(arts))
    top = tfidf.top_keywords(tfidf.score(tf, vocab))
    return KeywordStage(arts, tf, vocab, top, tfidf.with_article(top, arts))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_stage(spark, sf_dir).vocabulary


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_stage(spark, sf_dir).keywords


def stop_words(vocab: DataFrame, n: int = 50) -> DataFrame:
    """No stop-word file ships with the data: the ``n`` most frequent
    vocabulary words stand in (at most ``n`` rows by construction)."""
    return vocab.where(F.col("index") < n).select(F.col("keyword").alias("word"))


# flags of the words of the registered segmentation
FUNCTION_WORD = "u"


def word_flag(index: Column, word: Column) -> Column:
    """The 50 most frequent words are function words, capitalised ones custom
    words (names), all others nouns."""
    capital = F.lower(F.substring(word, 1, 1)) != F.substring(word, 1, 1)
    return F.when(index < 50, FUNCTION_WORD).when(capital, segment.CUSTOM).otherwise(segment.NOUN)


def profile(spark: SparkSession, sf_dir: str, stage: KeywordStage | None = None) -> DataFrame:
    from quire.operators.profile import article_profile

    stage = stage or keyword_stage(spark, sf_dir)
    # the profile joins the article attributes itself: start from the
    # un-joined top keywords
    return article_profile(stage.top, stage.articles)


def word_vectors(spark: SparkSession, sf_dir: str, vocab: DataFrame) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return adapters.word_vectors_from_embeddings(vocab, emb)


def article_vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return adapters.article_vectors_from_embeddings(emb)


def new_and_history(spark: SparkSession, sf_dir: str):
    """The similarity job's two sides: articles since the as-of hour minus 2
    hours ("new") and since minus 30 days ("history")."""
    from quire.functions.windows import HISTORY_DAYS, NEW_ARTICLE_HOURS, since_days, since_hours

    av = article_vector_table(spark, sf_dir)
    as_of = latest(article_vector_table(spark, sf_dir), "article_time")
    new = av.where(F.col("article_time") >= since_hours(as_of, NEW_ARTICLE_HOURS))
    history = av.where(F.col("article_time") >= since_days(as_of, HISTORY_DAYS))
    return new, history


def behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "props", "event_type", "ts")
    return adapters.behaviour_from_events(ev)


# the recall job of the queries runs so long after the newest event: its 60-day
# limit then leaves out older events
RECALL_DELAY_DAYS = 45


def recall_as_of(spark: SparkSession, sf_dir: str) -> Column:
    ev = read_table(spark, sf_dir, "events")
    return latest(ev, "ts") + F.make_dt_interval(F.lit(RECALL_DELAY_DAYS))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.operators.recall import user_item_clicks

    return user_item_clicks(behaviour(spark, sf_dir), recall_as_of(spark, sf_dir))
