"""Each rule of the registered queries changes the rows it is given, so an
oracle row that agrees says something about the rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text
from quire.functions.windows import behaviour_date_limit, day_window, hourly_window, in_window, latest
from quire.operators import recall, similar, tfidf, vectors
from quire.plans import inputs, queries
from quire.sources import adapters
from quire.sources.tables import read_table

from paths import MEDIUM, SMALL


def test_dedup_removes_redelivered_rows(spark):
    delivered = inputs.redelivered_articles(spark, SMALL).count()
    assert queries.article_dedup(spark, SMALL).count() == inputs.articles(spark, SMALL).count() < delivered


def test_windows_keep_some_and_drop_some(spark):
    rows = inputs.news(spark, MEDIUM)
    as_of = inputs.as_of_value(spark, MEDIUM)
    total = rows.count()
    sizes = [rows.where(in_window(F.col("time"), b)).count() for b in (hourly_window(as_of), day_window(as_of, 1), day_window(as_of, 2))]
    assert 0 < sizes[0] < sizes[1] < sizes[2] < total / 5
    new, history = inputs.new_and_history(spark, MEDIUM)
    vectors_held = inputs.article_vector_table(spark, MEDIUM).count()
    assert 0 < new.count() < history.count() < vectors_held


def test_windows_are_constants_in_the_plan(spark):
    plan = queries.article_window(spark, MEDIUM)._jdf.queryExecution().toString()
    assert "scalar-subquery" not in plan.lower()


def test_behaviour_limit_and_quotes(spark):
    events = read_table(spark, MEDIUM, "events")
    rows = inputs.behaviour(spark, MEDIUM)
    as_of = latest(events, "ts") + F.make_dt_interval(F.lit(inputs.RECALL_DELAY_DAYS))
    kept = rows.where(F.col("dt") > behaviour_date_limit(as_of)).count()
    assert 0 < kept < rows.count()
    assert 0 < rows.where(F.col("articles").startswith('"')).count() < rows.count()
    assert queries.user_item_clicks(spark, MEDIUM).where(F.col("article_id").contains('"')).count() == 0


def test_html_rule_removes_tags(spark):
    pages = read_table(spark, SMALL, "pages")
    stripped = pages.select(F.length("html").alias("a"), F.length(text.strip_html(F.col("html"))).alias("b"))
    assert stripped.where("b < a").count() == pages.count()


def test_any_bigint_id_has_a_time(spark):
    ids = [0, 60_000_000, 6_000_000_000, 2**62]
    out = spark.createDataFrame([(i,) for i in ids], "i long").select(
        adapters.article_clock(F.col("i")).alias("a"), adapters.vector_clock(F.col("i")).alias("v")
    )
    assert all(r.a.year == 2024 and r.v.year == 2024 for r in out.collect())


def test_vocabulary_has_no_cap_unless_given(spark):
    tf = spark.createDataFrame([(1, f"w{i}", 1) for i in range(50)], "article_id long, word string, tf long")
    m = F.lit(1)
    assert tfidf.fit_vocabulary(tf, m).count() == 50
    assert tfidf.fit_vocabulary(tf, m, vocab_size=20).count() == 20


def test_recall_table_drops_unknown_ids_and_repeats(spark):
    rows = queries.recall_table(spark, SMALL).collect()
    assert rows and all(r.als_ids.count('"') == 2 * r.n_items for r in rows)
    assert queries.als_index(spark, SMALL).where("kind = 'user'").count() > len(rows)


def test_too_many_als_keys_are_named(spark, monkeypatch):
    monkeypatch.setattr(recall, "MAX_ALS_ID", 1)
    clicks = spark.createDataFrame([("a",), ("b",), ("c",)], "user_id string")
    try:
        recall.index_keys(clicks, "user_id", "als_id").collect()
    except Exception as e:
        assert "ALS holds at most 2 distinct user_id values" in str(e)
    else:
        raise AssertionError("no error")


def test_lsh_on_salted_buckets_and_its_recall(spark):
    new, history = inputs.new_and_history(spark, MEDIUM)
    run = lambda **o: {
        (r.article_id, r.similar_id, r.distance)
        for r in similar.similar_lsh(new, history, queries.SIMILAR_THRESHOLD, queries.LSH_BUCKET, queries.LSH_TABLES, **o).collect()
    }
    plain = run()
    assert run(hot_bucket_rows=7) == plain
    exact = {tuple(r) for r in queries.similar_articles_exact(spark, MEDIUM).collect()}
    assert plain <= exact and len(plain) >= 0.9 * len(exact)


def test_lsh_joins_ids_only(spark):
    new, history = inputs.new_and_history(spark, SMALL)
    plan = similar.similar_lsh(new, history, 1.2)._jdf.queryExecution().optimizedPlan().toString()
    distinct = [line for line in plan.splitlines() if "Aggregate [article_id" in line and "similar_id" in line]
    assert distinct and not any("articlevector" in line or "_nv" in line for line in distinct)


def test_cooccurrence_vectors_do_not_depend_on_the_layout(spark):
    arrays = spark.createDataFrame([(["a", "b", "c", "a", "b"],), (["b", "c", "a", "x"],), (["a", "b", "c"],)], "words array<string>")
    found = [
        {r.word: [round(x, 9) for x in r.vector] for r in vectors.cooccurrence_vectors(df, 200, 2, 2).collect()}
        for df in (arrays.coalesce(1), arrays.repartition(3))
    ]
    assert found[0] == found[1] and set(found[0]) == {"a", "b", "c"}
    assert all(len(v) == 200 for v in found[0].values())
