"""Article preparation edge rules (raw news fixture shape)."""

from __future__ import annotations

import datetime as dt

from quire.functions.windows import as_of_literal, day_window, hourly_window
from quire.operators import prepare

NEWS_SCHEMA = (
    "m_id long, context string, platform string, title string, our_tags string, "
    "descr string, source string, source_tags string, time timestamp_ntz"
)


def ts(s):
    return dt.datetime.fromisoformat(s)


def news(spark, rows):
    return spark.createDataFrame(rows, NEWS_SCHEMA)


def test_cleaning_and_sentence(spark):
    rows = [
        (1, None, "tech", "T1", None, None, "s", "tags", ts("2024-01-02 10:00:00")),
        (2, "", "tech", None, None, "", "s", None, ts("2024-01-02 10:00:00")),
        (3, "a\nb\rc\r\nd", "news", "T3", None, "x\ny", "s", "", ts("2024-01-02 10:00:00")),
        (4, "<p>hi</p>", None, "T4", None, None, None, None, ts("2024-01-02 10:00:00")),
    ]
    out = {r.article_id: r for r in prepare.prepare_articles(news(spark, rows)).collect()}
    assert out[1].content == "unknow" and out[1].article_describe == "unknow"
    assert out[1].sentence == "tags,tech,T1,unknow"
    # empty text -> placeholder; null title skipped by concat_ws
    assert out[2].content == "unknow" and out[2].sentence == "tech,unknow"
    # line breaks removed; empty source_tags kept as an empty field
    assert out[3].content == "abcd" and out[3].article_describe == "xy"
    assert out[3].sentence == ",news,T3,abcd"
    # tags are kept in the sentence (stripped only at tokenising)
    assert out[4].sentence == "T4,<p>hi</p>"
    assert out[4].channel_tags is None and out[4].source is None
    assert prepare.prepare_articles(news(spark, rows)).columns == prepare.ARTICLE_COLUMNS


def test_dedup_and_latest(spark):
    t1, t2 = ts("2024-01-02 10:00:00"), ts("2024-01-02 11:00:00")
    rows = [
        (1, "x", "c", "t", None, None, "s", None, t1),
        (1, "x", "c", "t", None, None, "s", None, t1),  # exact duplicate
        (1, "y", "c", "t", None, None, "s", None, t2),  # newer version
        (2, "z", "c", "t", None, None, "s", None, t1),
    ]
    arts = prepare.prepare_articles(news(spark, rows))
    assert prepare.dedup(arts).count() == 3
    latest = {r.article_id: r.content for r in prepare.latest_per_article(arts).collect()}
    assert latest == {1: "y", 2: "z"}


def test_hourly_window_bounds(spark):
    # as_of 12:10 -> window [10:30, 12:30)
    rows = [
        (i, "t", "c", None, None, None, "s", None, ts(t))
        for i, t in enumerate(
            ["2024-01-02 10:29:59", "2024-01-02 10:30:00", "2024-01-02 12:29:59", "2024-01-02 12:30:00"]
        )
    ]
    n = news(spark, rows)
    got = prepare.news_in_window(n, hourly_window(as_of_literal("2024-01-02 12:10:00")))
    assert sorted(r.m_id for r in got.collect()) == [1, 2]


def test_day_window_bounds(spark):
    rows = [
        (i, "t", "c", None, None, None, "s", None, ts(t))
        for i, t in enumerate(
            ["2024-01-01 00:00:00", "2024-01-01 23:59:59", "2024-01-02 00:00:00", "2023-12-31 23:59:59"]
        )
    ]
    n = news(spark, rows)
    got = prepare.news_in_window(n, day_window(as_of_literal("2024-01-02 08:00:00"), 1))
    assert sorted(r.m_id for r in got.collect()) == [0, 1]
    two = prepare.news_in_window(n, day_window(as_of_literal("2024-01-02 08:00:00"), 2))
    assert sorted(r.m_id for r in two.collect()) == [0, 1, 3]


def test_window_filter_reaches_scan(spark, scratch):
    rows = [(i, "t", "c", None, None, None, "s", None, ts("2024-01-02 11:00:00")) for i in range(3)]
    rows.append((3, "t", "c", None, None, None, "s", None, ts("2024-01-02 09:00:00")))
    news(spark, rows).write.parquet(scratch + "/news")
    n = spark.read.parquet(scratch + "/news")
    q = prepare.news_in_window(n, hourly_window(as_of_literal("2024-01-02 12:10:00")))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "time" in plan
    assert q.count() == 3


def test_scale_conf_sizes_partitions():
    from quire.session import scale_conf

    conf = scale_conf(100 * 1024**4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (128 * 1024**2)
    assert int(scale_conf(1024, 8)["spark.sql.shuffle.partitions"]) == 24


def test_dedup_equals_drop_duplicates(spark):
    base = [(i, f"text {i % 7}", "c", None, None, None, "s", None, ts("2024-01-02 10:00:00")) for i in range(60)]
    hot = [(1000, "copy", "c", None, None, None, "s", None, ts("2024-01-02 10:00:00"))] * 90  # a hot group of copies
    rows = base + base[:10] + hot
    arts = prepare.prepare_articles(news(spark, rows).repartition(5))
    expect = sorted(tuple(r) for r in arts.dropDuplicates().collect())
    for threshold in ("-1", "10m"):  # the repeated hashes shuffled, broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = sorted(tuple(r) for r in prepare.dedup(arts).collect())
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == expect
    assert len(expect) == 61
