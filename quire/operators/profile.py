"""Article profile: keyword -> weight map and topic list per article.

* keywords and weights come from one ``collect_list(struct(rank, keyword,
  tfidf))`` sorted by rank, so the two lists always align (the reference
  used two separate lists whose order only matched by chance);
* topics: the article's ``source_tags`` parsed into a list, unless they are
  null, the placeholder, or at most 3 characters long -- then the keywords;
* the article attributes are joined once on a one-row-per-article table (no
  fan-out when an article id repeats).

The group per article holds at most top-k rows, and the keyword table is
already hash-partitioned by article_id by the top-k window, so the aggregate
adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text

PROFILE_COLUMNS = ["article_id", "channel_name", "keyword", "topics", "article_time"]


def keyword_lists(keywords: DataFrame) -> DataFrame:
    """(article_id, keywords, weights) in rank order."""
    grouped = keywords.groupBy("article_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "keyword", "tfidf"))).alias("_kw")
    )
    return grouped.select(
        "article_id",
        F.col("_kw.keyword").alias("keywords"),
        F.col("_kw.tfidf").alias("weights"),
    )


def topics(keywords_col, source_tags_col):
    return F.when(text.tags_unusable(source_tags_col), keywords_col).otherwise(
        text.parse_tag_list(source_tags_col)
    )


def article_profile(keywords: DataFrame, articles: DataFrame) -> DataFrame:
    """(article_id, channel_name, keyword map<string,double>, topics
    array<string>, article_time)"""
    lists = keyword_lists(keywords)
    attrs = articles.select("article_id", "channel_name", "source_tags", "article_time")
    joined = lists.join(attrs, "article_id")
    return joined.select(
        "article_id",
        "channel_name",
        F.map_from_arrays("keywords", "weights").alias("keyword"),
        topics(F.col("keywords"), F.col("source_tags")).alias("topics"),
        "article_time",
    )


def explode_profile(profile: DataFrame) -> DataFrame:
    """(article_id, channel_name, keyword, weight, article_time): one row per
    map entry."""
    return profile.select(
        "article_id",
        "channel_name",
        F.explode("keyword").alias("keyword", "weight"),
        "article_time",
    )
