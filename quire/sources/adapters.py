"""Adapters from the driver tables to the shapes the pipeline consumes.

The reference reads raw news rows, a behaviour table, word vectors and article
vectors from its own warehouse.  Here they are derived from the given tables
(``documents``, ``events``, ``embeddings``) by plain projections, so every
query's work grows with those tables:

* raw news        <- documents (id, text, language, source; a deterministic
                     synthetic publish time and tag text)
* behaviour       <- events (item = props.k, clicked = event_type 'click')
* word vectors    <- vocabulary index, modulo their count, joined to embeddings.vec_id
* article vectors <- embeddings (article id = vec_id)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.vectors import as_double_array

# Fixed values of the synthetic article clock: ids are spread over 45 days by
# a prime step, so every window grows with the table and the 30-day history
# leaves rows out.  Any bigint id has a time.
ARTICLE_EPOCH = "2024-01-01 00:00:00"
ARTICLE_PERIOD_MINUTES = 45 * 24 * 60
ARTICLE_STEP_MINUTES = 7919


def _at_minute(minute: Column) -> Column:
    return F.lit(ARTICLE_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), minute.cast("int")
    )


def article_clock(article_id: Column) -> Column:
    period = F.lit(ARTICLE_PERIOD_MINUTES)
    place = F.pmod(article_id, period) * ARTICLE_STEP_MINUTES
    return _at_minute(F.pmod(place, period))


def vector_clock(article_id: Column) -> Column:
    """As ``article_clock``, but every tenth vector is from the last 90 minutes:
    the "new" side of the similarity join is a tenth of the table."""
    place = F.pmod(F.pmod(article_id, F.lit(ARTICLE_PERIOD_MINUTES)) * 7, F.lit(90))
    recent = _at_minute(F.lit(ARTICLE_PERIOD_MINUTES - 1) - place)
    return F.when(F.pmod(article_id, F.lit(10)) == 0, recent).otherwise(article_clock(article_id))


def synthetic_source_tags(doc_id: Column, source: Column, lang: Column) -> Column:
    """Tag text covering every branch of the topics rule: null, the
    placeholder, a too-short list and a real list."""
    k = F.pmod(doc_id, F.lit(4))
    return (
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, F.lit("unknow"))
        .when(k == 2, F.lit("[]"))
        .otherwise(F.concat(F.lit('["'), source, F.lit('", "'), lang, F.lit('"]')))
    )


def news_from_documents(documents: DataFrame) -> DataFrame:
    """Raw news rows (m_id, context, platform, title, our_tags, descr, source,
    source_tags, time) from ``documents``."""
    none = F.lit(None).cast("string")
    return documents.select(
        F.col("doc_id").alias("m_id"),
        F.col("text").alias("context"),
        F.col("lang").alias("platform"),
        none.alias("title"),
        none.alias("our_tags"),
        none.alias("descr"),
        F.col("source"),
        synthetic_source_tags(F.col("doc_id"), F.col("source"), F.col("lang")).alias("source_tags"),
        article_clock(F.col("doc_id")).alias("time"),
    )


def redelivered(news: DataFrame) -> DataFrame:
    """Raw rows as an overlapping feed delivers them: every tenth comes twice,
    every hundredth three times."""
    times = F.when(F.pmod("m_id", F.lit(100)) == 3, 3).when(F.pmod("m_id", F.lit(10)) == 3, 2).otherwise(1)
    copies = news.withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    return copies.drop("_copy")


# the period comes in so many deliveries
DELIVERIES = 4


def deliveries(news: DataFrame) -> DataFrame:
    """The news as a feed (article_id, content_hash, channel_name, n_chars, time,
    delivery): each row in the delivery of its quarter of the period; every tenth
    again in the next one, every seventh two deliveries late, every eleventh one."""
    minute = F.timestamp_diff("MINUTE", F.lit(ARTICLE_EPOCH).cast("timestamp_ntz"), F.col("time"))
    last = F.lit(DELIVERIES - 1)
    own = F.floor(minute * DELIVERIES / ARTICLE_PERIOD_MINUTES).cast("int")
    late = F.when(F.pmod("m_id", F.lit(7)) == 2, 2).when(F.pmod("m_id", F.lit(11)) == 4, 1).otherwise(0)
    first = F.least(own + late, last)
    every = F.when(F.pmod("m_id", F.lit(10)) == 3, F.array(first, F.least(first + 1, last))).otherwise(F.array(first))
    return news.select(
        F.col("m_id").alias("article_id"),
        F.xxhash64("context").alias("content_hash"),
        F.col("platform").alias("channel_name"),
        F.coalesce(F.length("context"), F.lit(0)).cast("long").alias("n_chars"),
        F.col("time").cast("timestamp").alias("time"),
        F.explode(every).alias("delivery"),
    )


def behaviour_from_events(events: DataFrame) -> DataFrame:
    """Behaviour rows (user_id, articles, click_art, dt) from ``events``; the
    item ids of every third user carry quotes, as some feeds write them."""
    item = F.get_json_object("props", "$.k")
    quoted = F.concat(F.lit('"'), item, F.lit('"'))
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.pmod("user_id", F.lit(3)) == 0, quoted).otherwise(item).alias("articles"),
        (F.col("event_type") == "click").cast("int").alias("click_art"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )


def word_vectors_from_embeddings(vocabulary: DataFrame, embeddings: DataFrame) -> DataFrame:
    """(word, vector): the words take the embeddings in turn by vocabulary
    index, so every word has a vector (of another word too, where there are more
    words than embeddings)."""
    emb = embeddings.select(F.col("vec_id"), as_double_array(F.col("embedding")).alias("vector"))
    turn = F.pmod(F.col("index"), embeddings.select(F.count(F.lit(1))).scalar())
    words = vocabulary.select(F.col("keyword").alias("word"), turn.alias("vec_id"))
    return words.join(emb, "vec_id").select("word", "vector")


def article_vectors_from_embeddings(embeddings: DataFrame) -> DataFrame:
    """(article_id, channel_name, articlevector, article_time)."""
    return embeddings.select(
        F.col("vec_id").alias("article_id"),
        F.col("label").cast("string").alias("channel_name"),
        as_double_array(F.col("embedding")).alias("articlevector"),
        vector_clock(F.col("vec_id")).alias("article_time"),
    )
