"""Vocabulary, IDF, TF-IDF and the top keywords of each article.

Semantics (those of MLlib's CountVectorizer + IDF as the reference uses them):

* vocabulary: words with document frequency >= ``min_df`` (a count, or a
  fraction of the documents when < 1), all of them or the ``vocab_size`` most
  frequent by corpus count (the reference passes PARITY_VOCAB_SIZE); index = rank by (count desc, word asc).  MLlib breaks count
  ties arbitrarily; the word order makes the index reproducible.
* idf = ln((m + 1) / (df + 1)), m = number of articles (also those without a
  token); a word in every article gets 0 and stays.
* tf = occurrences of the word in the article; words outside the vocabulary
  are dropped; tfidf = tf * idf.
* top keywords: the ``k`` highest tfidf per article, ties by ascending index,
  tfidf rounded to 4 decimals after ranking.

Plan shape: tokens -> aggregate on (article_id, word), materialized once in
the checkpoint folder (the text is read and tokenised a single time) -> the
vocabulary aggregate on word (partial aggregation map-side, so a word found
in every article is one row per task before the shuffle) -> words below the
cap's count dropped (exact) -> distributed index -> vocabulary stored ->
the scoring join on word (vocabulary broadcast only after a row
count check, else its most frequent words; the rest sort-merge) -> top-k window per
article with the group limit applied before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.joins import row_count_at_most
from quire.functions.lineage import materialize
from quire.functions.ranking import consecutive_index, top_k_per_group

# Fixed values of the reference's keyword stage.
PARITY_VOCAB_SIZE = 2_000_000
MIN_DF = 1.0
TOP_K = 20
WEIGHT_DECIMALS = 4
# largest vocabulary broadcast to the scoring join (ours)
VOCAB_BROADCAST_ROWS = 500_000


def term_frequency(tokens: DataFrame) -> DataFrame:
    """(article_id, word, tf)"""
    return tokens.groupBy("article_id", "word").agg(F.count(F.lit(1)).alias("tf"))


def document_count(articles: DataFrame) -> Column:
    """m as a scalar subquery over the article rows."""
    return articles.select(F.count(F.lit(1))).scalar()


def cap_count(stats: DataFrame, vocab_size: int) -> Column:
    """The smallest corpus count a word can have and still be among the
    ``vocab_size`` most frequent (0 when fewer words exist), as a scalar
    subquery.  Filtering on it before the index sort is exact: every word
    at that count is kept, so ties keep their order, and the sort only sees
    about ``vocab_size`` words however many distinct tokens the corpus has.
    The histogram has one row per distinct count value (at most
    sqrt(2 x tokens)), so its running sum may run in one task."""
    hist = stats.groupBy("count").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy(F.col("count").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.select("count", F.sum("_n").over(running).alias("_cum"))
    reach = cum.where(F.col("_cum") >= vocab_size).agg(F.max("count")).scalar()
    return F.coalesce(reach, F.lit(0))


def fit_vocabulary(
    tf: DataFrame,
    n_docs: Column,
    vocab_size: int | None = None,
    min_df: float = MIN_DF,
) -> DataFrame:
    """(keyword, count, df, idf, index) from a term-frequency table."""
    stats = tf.groupBy("word").agg(
        F.sum("tf").alias("count"), F.count(F.lit(1)).alias("df")
    )
    floor = F.lit(min_df) if min_df >= 1.0 else F.lit(min_df) * n_docs
    stats = stats.where(F.col("df") >= floor)
    if vocab_size is not None:
        stats = stats.where(F.col("count") >= cap_count(stats, vocab_size))
    ranked = consecutive_index(stats, [F.col("count").desc(), F.col("word").asc()])
    if vocab_size is not None:
        ranked = ranked.where(F.col("index") < vocab_size)
    idf = F.log((n_docs + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    vocabulary = ranked.select(
        F.col("word").alias("keyword"),
        F.col("count"),
        F.col("df"),
        idf.alias("idf"),
        F.col("index"),
    )
    # read several times downstream (scoring join, its size check, stop words,
    # word vectors): store it once
    return materialize(vocabulary)


def score(
    tf: DataFrame, vocabulary: DataFrame, max_broadcast_rows: int = VOCAB_BROADCAST_ROWS
) -> DataFrame:
    """(article_id, keyword, index, tf, idf, tfidf); out-of-vocabulary words
    are dropped by the inner join.

    The vocabulary is broadcast when its row count is measured under
    ``max_broadcast_rows``.  Otherwise its ``max_broadcast_rows`` most frequent words
    (the first by index) are: nearly all rows find their word there, and only those
    of the other words, none of them frequent, are shuffled on the word
    (sort-merge).  The term-frequency side is never the broadcast side, whatever
    the size estimate of a checkpointed scan."""
    v = vocabulary.select("keyword", "index", "idf")
    weighted = F.col("tf") * F.col("idf")
    found = lambda rows: rows.select("article_id", "keyword", "index", "tf", "idf", weighted.alias("tfidf"))
    # the broadcast words are looked up by a long; as bounds, the words' equality
    # stays a condition and is not made part of the key
    hashed = tf.withColumn("_h", F.xxhash64("word"))
    same = (F.col("_h") == F.col("_k")) & (F.col("word") >= F.col("keyword")) & (F.col("word") <= F.col("keyword"))
    key = F.xxhash64("keyword").alias("_k")
    if row_count_at_most(v, max_broadcast_rows):
        return found(hashed.join(F.broadcast(v.select("*", key)), same))
    frequent = F.col("index") < max_broadcast_rows
    first = F.broadcast(v.where(frequent).select("*", key))
    others = hashed.join(first.select("keyword", "_k"), same, "left_anti").hint("merge")
    rest = v.where(~frequent)
    return found(hashed.join(first, same)).unionByName(found(others.join(rest, others["word"] == rest["keyword"])))


def top_keywords(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    """(article_id, keyword, index, tfidf, rank): rank 1..k per article."""
    ranked = top_k_per_group(
        scored, "article_id", [F.col("tfidf").desc(), F.col("index").asc()], k
    )
    return ranked.select(
        "article_id",
        "keyword",
        "index",
        F.round("tfidf", WEIGHT_DECIMALS).alias("tfidf"),
        "rank",
    )


def with_article(keywords: DataFrame, articles: DataFrame) -> DataFrame:
    """The stored keyword shape (article_id, channel_name, keyword, tfidf,
    article_time) plus the rank."""
    a = articles.select("article_id", "channel_name", "article_time")
    return keywords.join(a, "article_id").select(
        "article_id", "channel_name", "keyword", "tfidf", "article_time", "rank"
    )


def keyword_stage(
    tokens: DataFrame,
    articles: DataFrame,
    vocabulary: DataFrame | None = None,
    k: int = TOP_K,
    vocab_size: int | None = None,
    min_df: float = MIN_DF,
) -> tuple[DataFrame, DataFrame]:
    """Full build (vocabulary fitted on ``tokens``) or incremental scoring
    (a stored ``vocabulary`` given).  Returns (vocabulary, keywords)."""
    return keyword_stage_from_tf(term_frequency(tokens), articles, vocabulary, k, vocab_size, min_df)


def keyword_stage_from_tf(
    tf: DataFrame,
    articles: DataFrame,
    vocabulary: DataFrame | None = None,
    k: int = TOP_K,
    vocab_size: int | None = None,
    min_df: float = MIN_DF,
) -> tuple[DataFrame, DataFrame]:
    """As ``keyword_stage`` from a term-frequency table; pass a materialized
    one when it feeds both the vocabulary fit and the scoring."""
    if vocabulary is None:
        vocabulary = fit_vocabulary(tf, document_count(articles), vocab_size, min_df)
    keywords = with_article(top_keywords(score(tf, vocabulary), k), articles)
    return vocabulary, keywords
