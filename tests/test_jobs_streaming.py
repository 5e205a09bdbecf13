"""Sinks, composed jobs and the streaming incremental path."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions.windows import as_of_literal
from quire.plans.catalog import register_views
from quire.plans.jobs import (
    Stores,
    daily_merge,
    daily_recall,
    full_rebuild,
    hourly_update,
    refresh_article_vectors,
)
from quire.plans import jobs
from quire.sources.models import load_als, load_word2vec
from quire.sinks.snapshots import committed
from quire.sinks.writers import compact, read_if_exists, read_keyed, upsert_keyed, write_partitioned
from quire.sources import adapters
from quire.streaming.incremental import process_batch, start_incremental

from paths import SMALL


def test_partitioned_overwrite_is_idempotent(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, part string")
    path = scratch + "/t"
    write_partitioned(df, path, ["part"])
    write_partitioned(df.where("part = 'a'"), path, ["part"])
    assert spark.read.parquet(path).count() == 3
    write_partitioned(spark.createDataFrame([(9, "a")], "id long, part string"), path, ["part"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 9]


def test_upsert_latest_version_wins(spark, scratch):
    path = scratch + "/kw"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    schema = "article_id long, keyword string, v timestamp_ntz"
    upsert_keyed(spark, spark.createDataFrame([(1, "a", t1), (1, "b", t1), (2, "c", t1)], schema), path, ["article_id"], "v")
    upsert_keyed(spark, spark.createDataFrame([(1, "z", t2)], schema), path, ["article_id"], "v")
    # an older version does not replace a newer one
    upsert_keyed(spark, spark.createDataFrame([(1, "old", t1)], schema), path, ["article_id"], "v")
    got = sorted((r.article_id, r.keyword) for r in read_keyed(spark, path).collect())
    assert got == [(1, "z"), (2, "c")]
    # replaying the same batch changes nothing
    upsert_keyed(spark, spark.createDataFrame([(1, "z", t2)], schema), path, ["article_id"], "v")
    assert sorted((r.article_id, r.keyword) for r in read_keyed(spark, path).collect()) == got


def _news(spark):
    """Raw news 43 minutes apart, so that a two-hour window holds a few."""
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    time = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("m_id") * 43).cast("int"))
    return adapters.news_from_documents(docs).withColumn("time", time)


def _seen(spark, path):
    """As readers of complete batches see it; nothing if there is no table yet."""
    if read_if_exists(spark, path) is None:
        return []
    rows = read_keyed(spark, path, batches=committed(spark, os.path.dirname(path)))
    return sorted(map(repr, rows.drop("computed_at").collect()))


def _rows(spark, path):
    return sorted(map(repr, read_keyed(spark, path).drop("computed_at").collect()))


def _tables(spark, stores, rows=_rows):
    paths = (stores.articles, stores.index_keywords, stores.keywords, stores.profiles, stores.article_vectors, stores.similar, stores.processed)
    return {p.rsplit("/", 1)[1]: rows(spark, p) for p in paths}


def test_full_then_hourly_jobs(spark, scratch):
    stores = Stores(scratch + "/stores")
    news = _news(spark)
    cutoff = news.select(F.max("time")).first()[0] - dt.timedelta(hours=3)
    full_rebuild(spark, news.where(F.col("time") < F.lit(cutoff)), stores, vector_size=20, word2vec=True)
    n_before = read_keyed(spark, stores.articles).count()
    assert read_keyed(spark, stores.keywords).count() > 0
    assert spark.read.parquet(stores.word_vectors).count() > 0
    as_of = news.select(F.max("time")).first()[0]
    ran = hourly_update(spark, news, stores, as_of_literal(as_of), threshold=1000.0)
    assert ran
    after = read_keyed(spark, stores.articles)
    assert after.count() > n_before
    pairs = read_keyed(spark, stores.similar)
    assert pairs.where("article_id = similar_id OR distance = 0").count() == 0
    # re-running the same window changes nothing
    snapshot = sorted(tuple(r) for r in read_keyed(spark, stores.keywords).collect())
    assert not hourly_update(spark, news, stores, as_of_literal(as_of), threshold=1000.0)
    assert sorted(tuple(r) for r in read_keyed(spark, stores.keywords).collect()) == snapshot
    # an empty window stops after the article table
    assert not hourly_update(spark, news, stores, as_of_literal("2030-01-01 00:00:00"), threshold=1000.0)
    # stored tables are queryable by name
    views = register_views(spark, stores)
    assert {"article_profile", "tfidf_keywords_values", "similar_articles"} <= set(views)
    n = spark.sql("SELECT count(*) AS n FROM article_profile").first().n
    assert n == read_keyed(spark, stores.profiles).count()
    model = load_word2vec(stores.word2vec_model)
    assert model.getVectors().count() == spark.read.parquet(stores.word_vectors).count()


def test_views_show_current_rows_only(spark, scratch):
    stores = Stores(scratch + "/stores")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    schema = "article_id long, title string, article_time timestamp_ntz"
    put = lambda rows, **o: upsert_keyed(
        spark, spark.createDataFrame(rows, schema), stores.articles, ["article_id"], "article_time", **o
    )
    put([(1, "a", t1), (2, "b", t1), (3, "c", t1)])
    gone = spark.createDataFrame([(1, t2), (3, t2)], "article_id long, article_time timestamp_ntz")
    put([(1, "edited", t2)], touched=gone)
    spark.createDataFrame([("w", 0.5)], "keyword string, idf double").write.parquet(stores.vocabulary)
    assert set(register_views(spark, stores)) == {"article_data", "idf_keywords_values"}
    view = spark.table("article_data")
    assert view.columns == ["article_id", "title", "article_time"]
    assert sorted(tuple(r) for r in view.collect()) == [(1, "edited", t2), (2, "b", t1)]
    assert spark.sql("SELECT keyword FROM idf_keywords_values").collect()[0].keyword == "w"


def test_daily_recall_job(spark, scratch):
    stores = Stores(scratch + "/stores")
    ev = spark.read.parquet(SMALL + "/events.parquet")
    beh = adapters.behaviour_from_events(ev)
    as_of = as_of_literal(ev.select(F.max("ts")).first()[0])
    out = daily_recall(spark, beh, stores, as_of, n=10)
    rows = out.collect()
    assert rows and all(r.n_items <= 10 for r in rows)
    assert load_als(stores.als_model).rank == 10


def test_streaming_matches_batch(spark, scratch):
    news = _news(spark)
    src = scratch + "/incoming"
    # three deliveries, the second one repeating rows of the first
    news.where("m_id < 80").write.parquet(src + "/b1")
    news.where("m_id >= 60 AND m_id < 140").write.parquet(src + "/b2")
    news.where("m_id >= 140").write.parquet(src + "/b3")

    base = Stores(scratch + "/base")
    full_rebuild(spark, news, base, vector_size=16)

    stores = Stores(scratch + "/stream")
    # the stream scores against the stored vocabulary and word vectors
    spark.read.parquet(base.vocabulary).write.parquet(stores.vocabulary)
    spark.read.parquet(base.word_vectors).write.parquet(stores.word_vectors)

    schema = news.schema
    q = start_incremental(spark, src + "/*", schema, stores, scratch + "/ckpt", threshold=50.0)
    q.awaitTermination(300)
    assert q.exception() is None

    key = lambda df: sorted(tuple(r) for r in df.select("article_id", "keyword", "tfidf").collect())
    assert key(read_keyed(spark, stores.keywords)) == key(read_keyed(spark, base.keywords))
    assert read_keyed(spark, stores.articles).count() == news.count()
    # a restarted query finds nothing new and changes nothing
    q2 = start_incremental(spark, src + "/*", schema, stores, scratch + "/ckpt", threshold=50.0)
    q2.awaitTermination(300)
    assert key(read_keyed(spark, stores.keywords)) == key(read_keyed(spark, base.keywords))


def test_daily_merge_and_vector_refresh(spark, scratch):
    stores = Stores(scratch + "/stores")
    news = _news(spark)
    as_of = news.select(F.max("time")).first()[0]
    d = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    n = daily_merge(spark, news, stores, as_of_literal(as_of))
    expect = news.where((F.col("time") >= F.lit(d - dt.timedelta(days=1))) & (F.col("time") < F.lit(d))).count()
    assert n == expect and read_keyed(spark, stores.articles).count() == expect
    full_rebuild(spark, news, stores, vector_size=16)
    before = {r.article_id: r.articlevector for r in read_keyed(spark, stores.article_vectors).collect()}
    after = {r.article_id: r.articlevector for r in refresh_article_vectors(spark, stores, as_of_literal(as_of)).collect()}
    # recomputing from the same stored profiles and word vectors changes nothing
    assert after == before


def test_streaming_keeps_late_and_newer_versions(spark, scratch):
    news = _news(spark)
    base = Stores(scratch + "/base")
    full_rebuild(spark, news, base, vector_size=16)
    stores = Stores(scratch + "/stream")
    spark.read.parquet(base.vocabulary).write.parquet(stores.vocabulary)
    src = scratch + "/incoming"
    schema = news.schema
    run = lambda: start_incremental(spark, src + "/*", schema, stores, scratch + "/ckpt", threshold=50.0).awaitTermination(300)

    news.where("m_id >= 100").write.parquet(src + "/b1")  # newer articles first
    run()
    news.where("m_id < 100").write.parquet(src + "/b2")  # older ones, days late
    run()
    assert read_keyed(spark, stores.articles).count() == news.count()

    # a re-delivery of the same versions changes nothing; a newer version of
    # article 5 replaces the stored one and its keywords
    before = sorted(tuple(r) for r in read_keyed(spark, stores.keywords).collect())
    news.where("m_id < 10").write.parquet(src + "/b3")
    run()
    assert sorted(tuple(r) for r in read_keyed(spark, stores.keywords).collect()) == before
    newer = news.where("m_id = 5").withColumn("time", F.col("time") + F.expr("INTERVAL 1 DAY")).withColumn(
        "context", F.lit("zebra zebra quokka")
    )
    newer.write.parquet(src + "/b4")
    run()
    art = read_keyed(spark, stores.articles).where("article_id = 5").collect()
    assert len(art) == 1 and art[0].content == "zebra zebra quokka"
    kw = read_keyed(spark, stores.keywords).where("article_id = 5").collect()
    # keywords now come from the new sentence ("unknow,<lang>,zebra zebra
    # quokka"; only words of the stored vocabulary) and carry the new time
    assert kw and {r.keyword for r in kw} <= {"unknow", "zebra", "quokka"}
    assert {r.article_time for r in kw} == {art[0].article_time}


@pytest.mark.parametrize("path", ["hourly", "stream"])
def test_a_failed_run_is_repeated_whole(spark, scratch, monkeypatch, path):
    """Fail once after each write; the next run ends in the tables of a clean one."""
    news = _news(spark).where("m_id < 40")
    base = scratch + "/base"
    full_rebuild(spark, news.where("m_id < 36"), Stores(base), vector_size=8)
    as_of = as_of_literal(news.select(F.max("time")).first()[0])

    def run(stores):
        if path == "hourly":
            return hourly_update(spark, news, stores, as_of, threshold=60.0, exact=True)
        return process_batch(spark, stores, news.where("m_id >= 34"), 60.0, exact=True)

    def copy(name):
        shutil.copytree(base, f"{scratch}/{name}")
        return Stores(f"{scratch}/{name}")

    clean = copy("clean")
    run(clean)
    want = _tables(spark, clean)
    assert len(want["article_data"]) > 36 and want["similar_articles"]
    assert _tables(spark, clean, _seen) == want
    before = _tables(spark, Stores(base), _seen)
    write = jobs.upsert_keyed
    # the hourly job after each of its writes, the stream (the same chain) after some
    for writes in range(7) if path == "hourly" else (0, 3, 6):
        stores, done = copy(f"try{writes}"), []

        def failing(*args, **kwargs):
            write(*args, **kwargs)
            done.append(1)
            if len(done) == writes + 1:
                raise RuntimeError("lost")

        monkeypatch.setattr(jobs, "upsert_keyed", failing)
        with pytest.raises(RuntimeError, match="lost"):
            run(stores)
        monkeypatch.setattr(jobs, "upsert_keyed", write)
        if writes in (3, 6):  # readers see nothing of the run that failed
            assert _tables(spark, stores, _seen) == before
        run(stores)
        assert _tables(spark, stores) == want


@pytest.mark.parametrize("path", ["hourly", "stream"])
def test_jobs_find_similar_articles_by_lsh(spark, scratch, path):
    """The default join of the jobs against the exact one, at thresholds that
    keep a few, many and nearly all pairs."""
    news = _news(spark)
    base = scratch + "/base"
    full_rebuild(spark, news.where("m_id < 190"), Stores(base), vector_size=64)
    as_of = as_of_literal(news.select(F.max("time")).first()[0])
    vectors = read_keyed(spark, Stores(base).article_vectors).select("articlevector").collect()
    v = np.array([r.articlevector for r in vectors])
    apart = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))[np.triu_indices(len(v), 1)]

    def pairs(name, threshold, **options):
        stores = Stores(f"{scratch}/{name}")
        shutil.copytree(base, stores.root)
        if path == "hourly":
            hourly_update(spark, news, stores, as_of, threshold, **options)
        else:
            process_batch(spark, stores, news.where("m_id >= 170"), threshold, **options)
        return {(r.article_id, r.similar_id) for r in read_keyed(spark, stores.similar).collect()}

    for share in (20, 95) if path == "stream" else (60,):
        threshold = float(np.percentile(apart, share))
        exact = pairs(f"exact{share}", threshold, exact=True)
        found = pairs(f"lsh{share}", threshold)
        print(f"{path} share {share} threshold {threshold:.2f} exact {len(exact)} lsh {len(found)}")
        assert len(exact) > 20 and found <= exact and len(found) >= 0.9 * len(exact)
    # the caller's own set-up reaches the join: buckets far too narrow lose pairs
    assert len(pairs("narrow", threshold, bucket_length=threshold / 1000, num_hash_tables=1)) < len(found) / 2


def test_a_newer_version_leaves_no_stale_rows(spark, scratch):
    news = _news(spark).where("m_id < 60")
    stores = Stores(scratch + "/s")
    full_rebuild(spark, news, stores, vector_size=8)
    held = [stores.keywords, stores.index_keywords, stores.profiles, stores.article_vectors]
    assert all(read_keyed(spark, p).where("article_id = 5").count() for p in held)
    # the new text has no word of the vocabulary but its language; same time, edited
    edited = news.where("m_id = 5").withColumns({"context": F.lit("qqq"), "platform": F.lit("-"), "source_tags": F.lit(None).cast("string")})
    process_batch(spark, stores, edited, 50.0)
    assert read_keyed(spark, stores.articles).where("article_id = 5").first().content == "qqq"
    assert not any(read_keyed(spark, p).where("article_id = 5").count() for p in held)


def test_deltas_touch_only_their_days(spark, scratch):
    path, schema = scratch + "/d", "article_id long, v timestamp_ntz"
    days = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    upsert_keyed(spark, spark.createDataFrame([(i, days[i % 5]) for i in range(500)], schema), path, ["article_id"], "v")

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part")}

    before = files()
    assert len(before) == 5  # one per day, however many tasks
    upsert_keyed(spark, spark.createDataFrame([(7, days[3])], schema), path, ["article_id"], "v")
    new = files() - before
    assert before <= files() and len(new) == 1 and "_day=2024-01-04" in new.pop()
    # a time bound leaves whole days unread
    recent = read_keyed(spark, path, F.lit(days[3]))
    assert {r.article_id for r in recent.collect()} == {7} | {i for i in range(500) if i % 5 > 2}
    assert "PartitionFilters: [isnotnull(_day" in recent._jdf.queryExecution().toString().replace("\n", "")
    rows = sorted(read_keyed(spark, path).collect())
    compact(spark, path)
    assert sorted(read_keyed(spark, path).collect()) == rows


def test_only_a_missing_path_is_no_table(spark, scratch):
    assert read_if_exists(spark, scratch + "/none") is None
    os.makedirs(scratch + "/empty")
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        read_if_exists(spark, scratch + "/empty")


def test_stop_words_and_lexicon_reach_every_store(spark, scratch):
    news = _news(spark).where("m_id < 60")
    plain, stores = Stores(scratch + "/a"), Stores(scratch + "/b")
    full_rebuild(spark, news, plain, vector_size=8)
    common = spark.read.parquet(plain.vocabulary).orderBy("index").limit(30).select(F.col("keyword").alias("word"))
    stops = spark.createDataFrame(common.collect(), "word string")
    half = spark.read.parquet(plain.vocabulary).where("index % 2 = 0").select(F.col("keyword").alias("word"))
    full_rebuild(spark, news.where("m_id < 50"), stores, vector_size=8, stop_words=stops, lexicon=half)
    process_batch(spark, stores, news.where("m_id >= 50"), 50.0, stop_words=stops, lexicon=half)
    words = {r.word for r in stops.collect()}
    allowed = {r.word for r in half.collect()}
    for table, column in ((read_keyed(spark, stores.keywords), "keyword"), (spark.read.parquet(stores.vocabulary), "keyword"), (spark.read.parquet(stores.word_vectors), "word")):
        found = {r[0] for r in table.select(column).distinct().collect()}
        assert found and not found & words and found <= allowed


def test_jobs_delete_their_intermediates(spark, scratch):
    from quire.session import checkpoint_dir

    tables = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    listing = lambda: set(os.listdir(tables)) if os.path.isdir(tables) else set()
    before = listing()
    stores = Stores(scratch + "/stores")
    full_rebuild(spark, _news(spark), stores, vector_size=16)
    assert listing() == before
    assert read_keyed(spark, stores.profiles).count() > 0
