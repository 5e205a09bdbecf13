"""Article preparation: raw news rows -> one cleaned article row with its
``sentence`` (the text the keyword stages read)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text
from quire.functions.lineage import materialize
from quire.functions.windows import in_window

# column order of the article table (inserts into it are positional)
ARTICLE_COLUMNS = [
    "article_id",
    "channel_name",
    "article_describe",
    "channel_tags",
    "title",
    "content",
    "source",
    "source_tags",
    "sentence",
    "article_time",
]


def rename_news(news: DataFrame) -> DataFrame:
    return news.select(
        F.col("m_id").alias("article_id"),
        F.col("context").alias("content"),
        F.col("platform").alias("channel_name"),
        F.col("title"),
        F.col("our_tags").alias("channel_tags"),
        F.col("descr").alias("article_describe"),
        F.col("source"),
        F.col("source_tags"),
        F.col("time").alias("article_time"),
    )


def prepare_articles(news: DataFrame) -> DataFrame:
    """Clean ``content``/``article_describe`` and build
    ``sentence = concat_ws(',', source_tags, channel_name, title, content)``.
    Other null columns stay null (the reference's fillna had no effect)."""
    a = rename_news(news)
    content = text.clean_text(F.col("content"))
    return a.select(
        "article_id",
        "channel_name",
        text.clean_text(F.col("article_describe")).alias("article_describe"),
        "channel_tags",
        "title",
        content.alias("content"),
        "source",
        "source_tags",
        text.sentence(F.col("source_tags"), F.col("channel_name"), F.col("title"), content).alias(
            "sentence"
        ),
        "article_time",
    )


def news_in_window(news: DataFrame, bounds: tuple[Column, Column]) -> DataFrame:
    """Half-open time window on the raw rows (pushed to the scan)."""
    return news.where(in_window(F.col("time"), bounds))


def dedup(articles: DataFrame) -> DataFrame:
    """Exact duplicate rows removed (all columns).

    ``dropDuplicates()`` shuffles every full row (the whole text at scale).
    Instead, every row is hashed (equal rows have equal hashes) and only the
    8-byte hashes are aggregated to find those seen more than once; a hot group
    of copies is one hash, collapsed map-side.  Rows whose hash is unique cannot
    have a copy; only the others go through ``dropDuplicates``, which compares
    full rows (a hash collision only adds a candidate, never merges different
    rows).  The plan is the same at every size: AQE broadcasts the repeated
    hashes when they are measured small and shuffles on the hash otherwise."""
    cols = articles.columns
    hashed = articles.withColumn("_h", F.xxhash64(*cols))
    repeated = materialize(
        hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_h")
    )
    flagged = hashed.join(repeated.withColumn("_rep", F.lit(True)), "_h", "left")
    unique = flagged.where(F.col("_rep").isNull()).select(*cols)
    copies = flagged.where(F.col("_rep")).select(*cols).dropDuplicates()
    return unique.unionByName(copies)


def latest_per_article(articles: DataFrame) -> DataFrame:
    """One row per article_id, the latest ``article_time`` wins (ties: the
    greatest row hash).  Re-delivered or re-published articles collapse instead
    of fanning out later joins.  The winner is chosen on (id, time, hash); the
    full rows are only filtered by it."""
    hashed = articles.withColumn("_h", F.xxhash64(*articles.columns))
    best = (
        hashed.groupBy("article_id")
        .agg(F.max(F.struct("article_time", "_h")).alias("_b"))
        .select("article_id", "_b._h")
    )
    # equal rows of a winner tie in everything: keep one
    best = best.select(F.col("article_id").alias("_a"), F.col("_h").alias("_w"))
    won = (F.col("_h") == F.col("_w")) & F.col("article_id").eqNullSafe(F.col("_a"))
    return hashed.join(best, won, "left_semi").select(*articles.columns).transform(dedup)
