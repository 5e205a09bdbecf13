"""Registered queries: one per operator group of the inventory.

Every query reads the driver tables under ``sf_dir`` (through the adapters in
``quire.sources.adapters``) and returns a lazy DataFrame.  Arrays and maps are
turned into rows or joined text in the final projection so results compare
row by row with the SQL oracles in ``quire.plans.oracle``; doubles are rounded
only there.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import vectors as vec
from quire.functions.lineage import materialize, spread
from quire.functions.windows import day_window, hourly_window, in_window
from quire.operators import als, prepare, segment, skipgram, tfidf, tokens, topn
from quire.operators.profile import explode_profile
from quire.operators.recall import (
    TOP_N,
    fit_als,
    index_keys,
    indexed_ratings,
    map_back,
    recall_lists,
    recommendations,
)
from quire.operators.recall import user_item_clicks as clicks_of
from quire.operators.similar import similar_exact, similar_lsh
from quire.operators.tokens import token_arrays
from quire.operators.vectors import FULL_BUILD_SIZE, article_vectors, cooccurrence_vectors
from quire.plans import inputs
from quire.plans.catalog import register_views
from quire.plans.jobs import Stores
from quire.session import checkpoint_dir
from quire.sinks.pairs import PAIR_KEYS, both_sides
from quire.sinks.snapshots import batch_of, begin, committed
from quire.sinks.writers import read_keyed, upsert_keyed
from quire.sources import adapters, behaviour
from quire.sources.tables import read_table
from quire.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

# decimals kept for idf / tfidf in compared output
SCORE_DECIMALS = 6
# distance threshold of the registered similarity queries: the test
# embeddings are unit vectors (pair distances about 1.0 to 1.8), where the
# reference's 380 would keep every pair
SIMILAR_THRESHOLD = 1.2
CLOSER_THRESHOLD = 1.1
# projections of unit vectors of 64 components spread by about 0.125
LSH_BUCKET, LSH_TABLES = 0.25, 6
# components of the registered word vectors, those of the full build
WORD_VECTOR_SIZE = FULL_BUILD_SIZE


def article_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.articles(spark, sf_dir)


def article_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates removed from a feed that delivers some rows again."""
    return prepare.dedup(inputs.redelivered_articles(spark, sf_dir))


def html_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the raw web pages after the tags are stripped."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    rows = spread(pages, "page_id").select(F.col("page_id").alias("article_id"), F.col("html").alias("sentence"))
    return tokens.tokenize(rows).withColumnRenamed("article_id", "page_id")


def article_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = inputs.news(spark, sf_dir)
    bounds = hourly_window(inputs.as_of_value(spark, sf_dir))
    return prepare.prepare_articles(prepare.news_in_window(news, bounds))


def article_window_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = inputs.news(spark, sf_dir)
    bounds = day_window(inputs.as_of_value(spark, sf_dir), 1)
    return prepare.prepare_articles(prepare.news_in_window(news, bounds))


def article_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.article_tokens(spark, sf_dir)


def article_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles with their blanks taken out, cut into words again by a lexicon
    of the words that make five in a million of the corpus or more; the 50 most
    frequent have a flag that the keep rule drops."""
    vocab = inputs.vocabulary(spark, sf_dir)
    arts = prepare.prepare_articles(spread(inputs.news(spark, sf_dir), "m_id"))
    unspaced = arts.select("article_id", F.translate("sentence", " ", "").alias("sentence"))
    lexicon = segment.lexicon_from_counts(vocab, inputs.word_flag(F.col("index"), F.col("keyword")))
    return segment.segment(unspaced, lexicon, stop_flags=(inputs.FUNCTION_WORD,), whole_latin=False)


def tokens_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop list is written as a text file and read back by the list reader;
    the text is tokenised once, for the list and for the output."""
    toks = materialize(inputs.article_tokens(spark, sf_dir))
    vocab = tfidf.fit_vocabulary(tfidf.term_frequency(toks), tfidf.document_count(inputs.articles(spark, sf_dir)))
    path = os.path.join(checkpoint_dir(spark), "stop_words", uuid.uuid4().hex)
    inputs.stop_words(vocab).write.text(path)
    return tokens.remove_stop_words(toks, tokens.stop_words_from_text(spark, path))


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = inputs.keyword_stage(spark, sf_dir)
    return tfidf.score(stage.tf, stage.vocabulary).select(
        "article_id",
        "keyword",
        "index",
        "tf",
        F.round("idf", SCORE_DECIMALS).alias("idf"),
        F.round("tfidf", SCORE_DECIMALS).alias("tfidf"),
    )


def keyword_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.vocabulary(spark, sf_dir).select(
        "keyword", "count", "df", F.round("idf", SCORE_DECIMALS).alias("idf"), "index"
    )


def article_keywords_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.keywords(spark, sf_dir)


def keyword_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    kw = inputs.keywords(spark, sf_dir)
    return kw.agg(
        F.count(F.lit(1)).alias("n_keywords"),
        F.count_distinct("article_id").alias("n_articles"),
    )


def article_keywords_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New articles (yesterday of the newest article) scored against the
    vocabulary and idf fitted on the articles published before them."""
    arts = prepare.prepare_articles(spread(inputs.news(spark, sf_dir), "m_id"))
    start, end = day_window(inputs.as_of_value(spark, sf_dir), 1)
    history = arts.where(F.col("article_time") < start)
    new = arts.where((F.col("article_time") >= start) & (F.col("article_time") < end))
    hist_tokens = tokens.tokenize(history.select("article_id", "sentence"))
    vocab = tfidf.fit_vocabulary(tfidf.term_frequency(hist_tokens), tfidf.document_count(history))
    new_tokens = tokens.tokenize(new.select("article_id", "sentence"))
    return tfidf.keyword_stage(new_tokens, new, vocabulary=vocab)[1]


def article_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per article: keyword count, the keywords (sorted, joined) and
    the topics (joined, in order)."""
    prof = inputs.profile(spark, sf_dir)
    return prof.select(
        "article_id",
        "channel_name",
        F.size("keyword").alias("n_keywords"),
        F.array_join(F.array_sort(F.map_keys("keyword")), ",").alias("keywords"),
        F.array_join("topics", ",").alias("topics"),
        "article_time",
    )


def article_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = inputs.profile(spark, sf_dir)
    return prof.select("article_id", F.posexplode("topics").alias("pos", "topic"))


def profile_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_profile(inputs.profile(spark, sf_dir))


def article_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article vectors from the profile and the word vectors, one row per
    component (rounded to 4 decimals)."""
    stage = inputs.keyword_stage(spark, sf_dir)
    prof = inputs.profile(spark, sf_dir, stage)
    wv = inputs.word_vectors(spark, sf_dir, stage.vocabulary)
    av = article_vectors(explode_profile(prof), wv)
    return av.select(
        "article_id", "channel_name", "article_time", F.posexplode("articlevector").alias("pos", "x")
    ).select(
        "article_id",
        "channel_name",
        "article_time",
        "pos",
        (F.round("x", 4) + F.lit(0.0)).alias("x"),
    )


def similar_articles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, history = inputs.new_and_history(spark, sf_dir)
    return similar_exact(new, history, threshold=SIMILAR_THRESHOLD)


def similar_articles_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, history = (materialize(x) for x in inputs.new_and_history(spark, sf_dir))
    return similar_lsh(new, history, SIMILAR_THRESHOLD, LSH_BUCKET, LSH_TABLES)


def article_vector_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the profiles of the last two whole days, one row per component."""
    bounds = day_window(inputs.as_of_value(spark, sf_dir), 2)
    rows = article_vector(spark, sf_dir)
    return rows.where(in_window(F.col("article_time"), bounds))


def keyword_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords by vocabulary index: (article_id, channel_name, index, tfidf)."""
    stage = inputs.keyword_stage(spark, sf_dir)
    return stage.top.join(stage.articles.select("article_id", "channel_name"), "article_id").select(
        "article_id", "channel_name", "index", "tfidf"
    )


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-occurrence word vectors, one row per component."""
    arts = prepare.prepare_articles(spread(inputs.news(spark, sf_dir), "m_id"))
    arrays = materialize(token_arrays(arts).select("words"))
    rows = cooccurrence_vectors(arrays, WORD_VECTOR_SIZE)
    return rows.select("word", F.posexplode("vector").alias("pos", "x")).select(
        "word", "pos", (F.round("x", 3) + F.lit(0.0)).alias("x")
    )


def skip_gram_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip-gram vectors of all words of the articles, at the reference's size."""
    arts = prepare.prepare_articles(spread(inputs.news(spark, sf_dir), "m_id"))
    return skipgram.fit(materialize(token_arrays(arts).select("words")))


def _store(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "stores", f"{name}-{uuid.uuid4().hex}")


def article_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article store after three deltas: all articles; every third again, a
    day newer with another title, every fifth a day older (which changes
    nothing) and every seventh without a row (which removes it); and a replay."""
    arts = materialize(inputs.articles(spark, sf_dir).select("article_id", "channel_name", "title", "article_time"))
    path, key = _store(spark, "articles"), ["article_id"]
    upsert_keyed(spark, arts, path, key, "article_time")
    day = F.make_dt_interval(F.lit(1))
    kind = lambda n: F.pmod("article_id", F.lit(n)) == 0
    newer = arts.where(kind(3)).withColumns({"title": F.lit("edited"), "article_time": F.col("article_time") + day})
    older = arts.where(kind(5) & ~kind(3)).withColumns({"title": F.lit("late"), "article_time": F.col("article_time") - day})
    gone = arts.where(kind(7) & ~kind(3) & ~kind(5)).select("article_id", "article_time")
    for _ in range(2):
        delta = newer.unionByName(older)
        touched = delta.select("article_id", "article_time").unionByName(gone)
        upsert_keyed(spark, delta, path, key, "article_time", touched)
    return read_keyed(spark, path)


def store_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named views over the article and keyword stores after a first run, an
    edit of every third article and the removal of every seventh, asked with
    SQL: the current articles with their current keywords."""
    stage = inputs.keyword_stage(spark, sf_dir)
    stores, key = Stores(_store(spark, "views")), ["article_id"]
    arts = materialize(stage.articles.select("article_id", "channel_name", "title", "article_time"))
    top = materialize(stage.keywords.where("rank <= 5"))
    upsert_keyed(spark, arts, stores.articles, key, "article_time")
    upsert_keyed(spark, top, stores.keywords, key, "article_time")
    later = (F.col("article_time") + F.make_dt_interval(F.lit(1))).alias("article_time")
    kind = lambda n: F.pmod("article_id", F.lit(n)) == 0
    touched = arts.where(kind(3) | kind(7)).select("article_id", later)
    edited = arts.where(kind(3)).select("article_id", "channel_name", F.lit("edited").alias("title"), later)
    upsert_keyed(spark, edited, stores.articles, key, "article_time", touched)
    kept = top.where(kind(3) & (F.col("rank") <= 2)).withColumn("article_time", later)
    upsert_keyed(spark, kept, stores.keywords, key, "article_time", touched)
    register_views(spark, stores)
    return spark.sql(
        """SELECT a.article_id, a.title, a.article_time, count(k.keyword) AS n_keywords,
                  concat_ws(',', sort_array(collect_list(k.keyword))) AS keywords
           FROM article_data a LEFT JOIN tfidf_keywords_values k ON k.article_id = a.article_id
           GROUP BY a.article_id, a.title, a.article_time"""
    )


def delivery_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles, characters and newest time per day and channel, from a stream over
    four deliveries with repeated and late rows, one run after each delivery."""
    feed = materialize(adapters.deliveries(inputs.news(spark, sf_dir)))
    path = _store(spark, "deliveries")
    schema = feed.drop("delivery").schema
    for d in range(adapters.DELIVERIES):
        feed.where(F.col("delivery") == d).drop("delivery").write.mode("append").parquet(path + "/feed")
        windows.run_available(spark, path + "/feed", schema, path + "/windows", path + "/progress")
    rows = spark.read.parquet(path + "/windows")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "newest")})


def snapshot_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with their length from two stores, read twice: between the two
    writes of a batch that edits every third article and never ends, and after one that
    edits every fifth."""
    stores, key = Stores(_store(spark, "snapshots")), ["article_id"]
    arts = materialize(
        inputs.articles(spark, sf_dir).select("article_id", "title", F.length("content").alias("n_chars"), "article_time")
    )

    def read() -> DataFrame:
        seen = committed(spark, stores.root)
        articles = read_keyed(spark, stores.articles, batches=seen)
        lengths = read_keyed(spark, stores.profiles, batches=seen)
        return materialize(articles.join(lengths, ["article_id", "article_time"]))

    def write(batch: int, rows: DataFrame, path: str) -> None:
        upsert_keyed(spark, rows, path, key, "article_time", batch=batch)

    def edited(every: int, days: int) -> DataFrame:
        later = F.col("article_time") + F.make_dt_interval(F.lit(days))
        rows = arts.where(F.pmod("article_id", F.lit(every)) == 0)
        return rows.withColumns({"title": F.lit(f"edit {days}"), "n_chars": F.col("n_chars") + days, "article_time": later})

    for rows in (arts, edited(5, 2)):
        with batch_of(spark, stores.root) as batch:
            write(batch, rows.drop("n_chars"), stores.articles)
            write(batch, rows.drop("title"), stores.profiles)
        if rows is arts:
            write(begin(spark, stores.root), edited(3, 1).drop("n_chars"), stores.articles)
            between = read()
    return between.withColumn("moment", F.lit("between")).unionByName(read().withColumn("moment", F.lit("after")))


def similar_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similar-articles store, kept on both sides, after a first run and a
    second one that recomputed the even articles with a closer threshold: all their
    pairs are replaced in both lists, those that are not found now are gone."""
    found = materialize(similar_articles_lsh(spark, sf_dir))
    path = _store(spark, "similar")
    even = found.where(F.pmod("article_id", F.lit(20)) == 0)
    runs = [(5, found, found), (6, even.where(F.col("distance") < CLOSER_THRESHOLD), even)]
    for day, pairs, touched in runs:
        at = F.lit(f"2024-02-1{day} 00:00:00").cast("timestamp_ntz")
        rows, replaced = both_sides(spark, pairs, path, touched, at)
        upsert_keyed(spark, rows, path, PAIR_KEYS, "computed_at", replaced)
    return read_keyed(spark, path)


def user_item_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.clicks(spark, sf_dir)


def behaviour_store_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks from the behaviour store after three batches, each with rows of every
    day, the second of them delivered twice; only the days within the limit are
    scanned."""
    rows, path = materialize(inputs.behaviour(spark, sf_dir)), _store(spark, "behaviour")
    part = F.pmod(F.xxhash64("user_id", "articles"), F.lit(3))
    for batch in (0, 1, 1, 2):
        behaviour.store_batch(rows.where(part == batch), path, str(batch))
    return clicks_of(behaviour.read_behaviour(spark, path), inputs.recall_as_of(spark, sf_dir))


def als_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both id maps in one table: (kind, key, als_id)."""
    # read by both id maps: parse the behaviour table once
    clicks = materialize(inputs.clicks(spark, sf_dir))
    users = index_keys(clicks, "user_id", "als_id").select(
        F.lit("user").alias("kind"), F.col("user_id").alias("key"), "als_id"
    )
    items = index_keys(clicks, "article_id", "als_id").select(
        F.lit("article").alias("kind"), F.col("article_id").alias("key"), "als_id"
    )
    return users.unionByName(items)


def als_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-50 ALS recall per user as a JSON id list."""
    # read by both id maps and the ratings: parse the behaviour table once
    clicks = materialize(inputs.clicks(spark, sf_dir))
    users = index_keys(clicks, "user_id", "als_user_id")
    items = index_keys(clicks, "article_id", "als_article_id")
    model = fit_als(indexed_ratings(clicks, users, items))
    return recall_lists(recommendations(model, users, items))


def als_recall_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ALS by normal equations and its exact top 50 for every user."""
    users, items = als.fit(inputs.clicks(spark, sf_dir))
    best = topn.top_products(users, items, TOP_N)
    return best.select(
        "user_id", F.col("rank").alias("rec_rank"), "article_id", (F.round("score", 6) + F.lit(0.0)).alias("rating")
    )


def factor_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact top 50 of stored factors: users are the sum of the vectors of what
    they clicked, articles their vector times one more than their clickers."""
    articles = inputs.article_vector_table(spark, sf_dir).select(
        F.col("article_id").cast("string").alias("article_id"), F.col("articlevector").alias("v")
    )
    clicked = materialize(inputs.clicks(spark, sf_dir).where("clicked = 1").select("user_id", "article_id"))
    counts = clicked.groupBy("article_id").agg(F.count(F.lit(1)).alias("n"))
    weight = F.lit(1.0) + F.coalesce(F.col("n"), F.lit(0))
    items = articles.join(counts, "article_id", "left").select("article_id", vec.scale(F.col("v"), weight).alias("factor"))
    users = vec.sums(clicked.join(articles, "article_id"), "user_id", "v").withColumnRenamed("v", "factor")
    # each side is read several times: written once, as stored factors are
    best = topn.top_products(materialize(users), materialize(items), TOP_N)
    return best.withColumn("score", F.round("score", 6) + F.lit(0.0))


def als_recall_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the recall job must give whatever ALS learned: every user with a
    click has a list of min(TOP_N, items) different known articles."""
    items = inputs.clicks(spark, sf_dir).select("article_id").distinct()
    rows = als_recall(spark, sf_dir).withColumn("article_id", F.explode(F.from_json("als_ids", "array<string>")))
    known = rows.join(items, "article_id")
    return known.groupBy("user_id").agg(
        F.max("n_items").alias("n_items"), F.count_distinct("article_id").alias("n_known")
    )


def recall_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tail of the recall job on recommendations that follow from the
    events: each user gets the items of the user behind, best first, with a
    repeat of the best and an id that no article has; user ids without a
    user drop out."""
    clicks = materialize(inputs.clicks(spark, sf_dir))
    users = index_keys(clicks, "user_id", "als_user_id")
    items = index_keys(clicks, "article_id", "als_article_id")
    rated = indexed_ratings(clicks, users, items)
    pick = F.struct((-F.col("clicked")).alias("score"), "als_article_id")
    lists = rated.groupBy("als_user_id").agg(F.sort_array(F.collect_list(pick)).alias("l"))
    known = F.transform("l", lambda x: _recommended(x["als_article_id"], -x["score"]))
    extra = F.array(_recommended(F.lit(-1), F.lit(0.5)), _recommended(F.element_at("l", 1)["als_article_id"], F.lit(0.4)))
    recommended = lists.select(
        (F.col("als_user_id") + 1).alias("als_user_id"), F.concat(known, extra).alias("recommendations")
    )
    return recall_lists(map_back(recommended, users, items))


def _recommended(item, rating):
    return F.struct(item.cast("int").alias("als_article_id"), rating.cast("float").alias("rating"))


QUERIES: dict[str, Query] = {
    "article_prepare": article_prepare,
    "article_dedup": article_dedup,
    "article_window": article_window,
    "article_window_daily": article_window_daily,
    "article_tokens": article_tokens,
    "article_segments": article_segments,
    "tokens_filtered": tokens_filtered,
    "term_frequency": term_frequency,
    "keyword_vocabulary": keyword_vocabulary,
    "article_keywords_top20": article_keywords_top20,
    "keyword_count": keyword_count,
    "article_keywords_incremental": article_keywords_incremental,
    "article_profile": article_profile,
    "article_topics": article_topics,
    "profile_explode": profile_explode,
    "article_vector": article_vector,
    "similar_articles_exact": similar_articles_exact,
    "similar_articles_lsh": similar_articles_lsh,
    "word_vectors": word_vectors,
    "skip_gram_vectors": skip_gram_vectors,
    "user_item_clicks": user_item_clicks,
    "behaviour_store_clicks": behaviour_store_clicks,
    "als_index": als_index,
    "als_recall": als_recall,
    "als_recall_exact": als_recall_exact,
    "als_recall_coverage": als_recall_coverage,
    "factor_recall": factor_recall,
    "recall_table": recall_table,
    "html_words": html_words,
    "keyword_index_table": keyword_index_table,
    "article_vector_refresh": article_vector_refresh,
    "article_store_upsert": article_store_upsert,
    "similar_store_upsert": similar_store_upsert,
    "snapshot_reads": snapshot_reads,
    "store_views": store_views,
    "delivery_windows": delivery_windows,
}
