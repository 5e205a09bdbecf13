"""The behaviour store: batches, repeated deliveries, days pruned before the scan."""

from __future__ import annotations

import datetime as dt
import os

from quire.functions.windows import latest
from quire.operators.recall import user_item_clicks
from quire.sources.behaviour import read_behaviour, store_batch


def rows(spark, data):
    return spark.createDataFrame(data, "user_id string, articles string, click_art int, dt string")


def stored(spark, path):
    return sorted(tuple(r) for r in read_behaviour(spark, path).collect())


def test_late_rows_join_their_day_and_a_repeated_batch_replaces_itself(spark, scratch):
    path = os.path.join(scratch, "behaviour")
    first = [("u1", "1", 1, "2024-01-01"), ("u2", "2", 0, "2024-01-02"), ("u3", "3", 0, None)]
    late = [("u9", "1", 1, "2024-01-01")]
    store_batch(rows(spark, first), path, "a")
    store_batch(rows(spark, late), path, "b")
    for _ in range(2):
        store_batch(rows(spark, first), path, "a")
    assert stored(spark, path) == sorted(first[:2] + late)
    assert dict(read_behaviour(spark, path).dtypes)["dt"] == "string"


def test_rows_that_look_alike_stay_apart(spark, scratch):
    path = os.path.join(scratch, "behaviour")
    twice = [("u1", "1", 1, "2024-01-01")] * 2
    store_batch(rows(spark, twice), path, "a")
    assert stored(spark, path) == twice


def test_only_the_kept_days_are_opened(spark, scratch):
    """The limit comes from a row of another table.  A file that is no Parquet lies
    in a day before the limit: a scan of that day would fail."""
    path = os.path.join(scratch, "behaviour")
    days = [f"2024-01-{d:02d}" for d in range(1, 29)]
    store_batch(rows(spark, [(f"u{i}", str(i), 1, d) for i, d in enumerate(days)]), path, "a")
    damaged = os.path.join(path, "dt=2024-01-02", "batch=a", "part-damaged.parquet")
    with open(damaged, "wb") as f:
        f.write(b"not a table")
    clock = spark.createDataFrame([(dt.datetime(2024, 3, 11, 6, 0),)], "ts timestamp_ntz")
    got = user_item_clicks(read_behaviour(spark, path), latest(clock, "ts"))  # later than 2024-01-11
    assert sorted(r.user_id for r in got.collect()) == sorted(f"u{i}" for i, d in enumerate(days) if d > "2024-01-11")
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "dt" in filters and "ubquery" in filters
