"""Event-time windows over repeated and late deliveries."""

from __future__ import annotations

import datetime as dt

from quire.streaming import windows

SCHEMA = "article_id long, content_hash long, channel_name string, n_chars long, time timestamp"


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_windows_close_once_and_state_expires(spark, scratch):
    src, sink, progress = (f"{scratch}/{x}" for x in ("feed", "windows", "progress"))

    def deliver(rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(src)
        return run()

    def run():
        schema = spark.createDataFrame([], SCHEMA).schema
        return windows.run_available(spark, src, schema, sink, progress, delay="1 day", window="1 day")

    def table():
        rows = spark.read.parquet(sink).collect()
        return sorted((r.window_start.day, r.channel_name or "", r.n_articles, r.n_chars) for r in rows)

    state = lambda reports: [op["numRowsTotal"] for op in reports[-1]["stateOperators"]]

    first = [(1, 1, "en", 10, _at(1, 1)), (2, 2, "en", 20, _at(1, 2)), (3, 3, None, 5, _at(2))]
    # a row twice in one delivery counts once; nothing is final yet (mark: 1st, 0 h)
    assert max(state(deliver([*first, first[0], (4, 4, "en", 1, None)]))) >= 3
    assert table() == []
    # delivered again, with other content (another row), and a new day: the 1st is final
    deliver([first[0], (2, 9, "en", 7, _at(1, 2)), (5, 5, "en", 8, _at(3, 12))])
    assert table() == [(1, "en", 3, 37)]
    # late for the 1st (mark: 2nd, 12 h), in time for the 2nd; then a day that closes all before
    deliver([(6, 6, "en", 100, _at(1, 5)), (7, 7, "en", 3, _at(2, 13)), first[2], (8, 8, "en", 4, _at(9))])
    assert table() == [(1, "en", 3, 37), (2, "", 1, 5), (2, "en", 1, 3), (3, "en", 1, 8)]
    # what remains is the newest row and its window: older keys are forgotten
    reports = deliver([(9, 9, "en", 1, _at(9, 1))])
    assert all(n <= 2 for n in state(reports))
    # a run without new files changes nothing
    before = table()
    run()
    assert table() == before
