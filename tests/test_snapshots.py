"""Batches over several stores, and similar pairs kept on both sides."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.functions import lineage
from quire.sinks.pairs import PAIR_KEYS, both_sides, mirrored
from quire.sinks.snapshots import batch_of, begin, commit, committed
from quire.sinks.writers import compact, read_keyed, upsert_keyed

T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def _put(spark, path, rows, batch, touched=None):
    df = spark.createDataFrame(rows, "article_id long, title string, v timestamp_ntz")
    gone = None if touched is None else spark.createDataFrame(touched, "article_id long, v timestamp_ntz")
    upsert_keyed(spark, df, path, ["article_id"], "v", gone, batch)


def _see(spark, root, name="a", **options):
    return sorted(tuple(r) for r in read_keyed(spark, f"{root}/{name}", batches=committed(spark, root, **options)).collect())


def test_a_reader_between_two_writes_sees_the_old_state(spark, scratch):
    a, b = scratch + "/a", scratch + "/b"
    with batch_of(spark, scratch) as first:
        for path in (a, b):
            _put(spark, path, [(1, "x", T1), (2, "y", T1)], first)
    old = [(1, "x", T1), (2, "y", T1)]
    assert _see(spark, scratch) == _see(spark, scratch, "b") == old
    second = begin(spark, scratch)
    _put(spark, a, [(1, "edited", T2)], second, touched=[(1, T2), (2, T2)])
    # neither the edit nor the removal is seen, but the batch sees its own rows
    assert _see(spark, scratch) == _see(spark, scratch, "b") == old
    assert _see(spark, scratch, own=second) == [(1, "edited", T2)]
    _put(spark, b, [(1, "edited", T2)], second)
    assert _see(spark, scratch, "b") == old
    commit(spark, scratch, second)
    assert _see(spark, scratch) == [(1, "edited", T2)]
    assert _see(spark, scratch, "b") == [(1, "edited", T2), (2, "y", T1)]
    assert _see(spark, scratch, upto=first) == old


def test_a_failed_batch_is_never_seen(spark, scratch):
    with batch_of(spark, scratch) as first:
        _put(spark, scratch + "/a", [(1, "x", T1)], first)
    with pytest.raises(RuntimeError):
        with batch_of(spark, scratch) as lost:
            _put(spark, scratch + "/a", [(1, "lost", T3), (9, "lost", T3)], lost)
            raise RuntimeError("lost")
    with batch_of(spark, scratch) as third:
        _put(spark, scratch + "/a", [(1, "kept", T2)], third)
    assert _see(spark, scratch) == [(1, "kept", T2)]
    running = begin(spark, scratch)
    _put(spark, scratch + "/a", [(5, "running", T3)], running)
    compact(spark, scratch + "/a", committed(spark, scratch))
    assert _see(spark, scratch) == [(1, "kept", T2)]
    commit(spark, scratch, running)  # was being written while the store was compacted
    assert _see(spark, scratch) == [(1, "kept", T2), (5, "running", T3)]


def test_before_the_first_batch(spark, scratch):
    assert committed(spark, scratch) is None  # no manifest: no batches
    _put(spark, scratch + "/a", [(1, "x", T1)], None)
    assert _see(spark, scratch) == [(1, "x", T1)]
    begin(spark, scratch + "/new")
    assert committed(spark, scratch + "/new").count() == 0


def test_only_some_keys(spark, scratch):
    _put(spark, scratch + "/a", [(i, "x", T1) for i in range(5)], None)
    _put(spark, scratch + "/a", [(3, "y", T2)], None)
    some = spark.createDataFrame([(3,), (4,), (7,)], "article_id long")
    got = read_keyed(spark, scratch + "/a", only=some).collect()
    assert sorted((r.article_id, r.title) for r in got) == [(3, "y"), (4, "x")]
    with pytest.raises(ValueError):
        read_keyed(spark, scratch + "/a", only=some.withColumnRenamed("article_id", "title"))


def test_pairs_are_replaced_on_both_sides(spark, scratch):
    path = scratch + "/pairs"

    def run(day, touched, found):
        pairs = spark.createDataFrame(found, "article_id long, similar_id long, distance double")
        ids = spark.createDataFrame([(t,) for t in touched], "article_id long")
        rows, replaced = both_sides(spark, pairs, path, ids, F.lit(day))
        upsert_keyed(spark, rows, path, PAIR_KEYS, "computed_at", replaced)
        return sorted((r.article_id, r.similar_id, r.distance) for r in read_keyed(spark, path).collect())

    def both(*pairs):
        return sorted([(a, b, d) for a, b, d in pairs] + [(b, a, d) for a, b, d in pairs])

    first = [(1, 2, 0.5), (2, 1, 0.5), (1, 3, 0.7), (4, 3, 0.9)]  # (1, 2) found from both sides
    assert run(T1, [1, 2, 4], first) == both((1, 2, 0.5), (1, 3, 0.7), (3, 4, 0.9))
    # 1 was edited: it left 2, is closer to 3 and new to 4; 3 and 4 are as they were
    want = both((1, 3, 0.2), (1, 4, 0.3), (3, 4, 0.9))
    assert run(T2, [1], [(1, 3, 0.2), (1, 4, 0.3)]) == want
    assert run(T2, [1], [(1, 3, 0.2), (1, 4, 0.3)]) == want  # the same batch again
    # 3 has no partner any more; 8 never had one
    assert run(T3, [3, 8], []) == both((1, 4, 0.3))
    assert run(T3, [], []) == both((1, 4, 0.3))


def test_pairs_are_stored_without_a_copy(spark, scratch, monkeypatch):
    """Of the pairs one row each is shuffled, none is written beside the store, and of the
    first run no list of replaced pairs is made."""
    written, write = [], lineage.write_scratch
    monkeypatch.setattr(lineage, "write_scratch", lambda df, *a: written.append(df.columns) or write(df, *a))
    pairs = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5), (3, 3, 0.0), (None, 4, 0.1), (4, None, 0.1)], "article_id long, similar_id long, distance double")
    ids = pairs.select("article_id")
    for day in (T1, T2):
        rows, replaced = both_sides(spark, pairs, scratch + "/p", ids, F.lit(day))
        assert day == T2 or replaced.count() == 0
        upsert_keyed(spark, rows, scratch + "/p", PAIR_KEYS, "computed_at", replaced)
    assert all(c == ["article_id"] for c in written)
    got = {(r.article_id, r.similar_id) for r in read_keyed(spark, scratch + "/p").collect()}
    assert got == {(1, 2), (2, 1), (3, 3), (None, 4), (4, None)} and mirrored(pairs).count() == 5
    plan = mirrored(pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate [article_id")
