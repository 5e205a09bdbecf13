"""ALS by normal equations against numpy, exact top-n against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from paths import SMALL

from pyspark.sql import functions as F

from quire.functions import vectors as vec
from quire.operators import als, recall, topn
from quire.plans import inputs


def numpy_start(key, rank, seed):
    digest = lambda j: hashlib.md5(f"{seed}#{key}#{j}".encode()).hexdigest()
    return np.array([int(digest(j)[:8], 16) / 2**32 for j in range(rank)])


def numpy_als(rows, rank, max_iter, reg, seed):
    """Each system from its ratings, one key after the other."""
    items = {i: numpy_start(i, rank, seed) for _, i, _ in rows}
    users = {}
    for _ in range(max_iter):
        for side, fixed, a, b in ((users, items, 0, 1), (items, users, 1, 0)):
            own = {}
            for row in rows:
                own.setdefault(row[a], []).append((fixed[row[b]], row[2]))
            for key, given in own.items():
                x, r = np.array([v for v, _ in given]), np.array([v for _, v in given], dtype=float)
                side[key] = np.linalg.solve(x.T @ x + reg * len(given) * np.eye(rank), x.T @ r)
    return users, items


def ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id string, article_id string, clicked int")


def clicked_rows(users=25, items=14, seed=1):
    rnd = random.Random(seed)
    return [(f"u{u}", f"a{i}", int(rnd.random() < 0.4)) for u in range(users) for i in range(items) if rnd.random() < 0.5]


@pytest.mark.parametrize("rank, max_broadcast", [(1, 100), (3, 0), (10, 100)])
def test_factors_equal_numpy(spark, rank, max_broadcast):
    rows = clicked_rows()
    rows += [rows[0]] * 2  # repeated ratings count
    got = als.fit(ratings(spark, rows), rank=rank, max_iter=3, seed=9, max_broadcast=max_broadcast)
    for frame, want, key in zip(got, numpy_als(rows, rank, 3, 0.1, 9), ("user_id", "article_id")):
        found = {r[key]: np.array(r["factor"]) for r in frame.collect()}
        assert found.keys() == want.keys()
        assert max(np.abs(found[k] - want[k]).max() for k in want) < 1e-6


def test_equations_are_those_of_mllib(spark):
    """A user step on MLlib's own item factors gives MLlib's user factors of its
    last half step turned round: items follow users, so items are compared."""
    rows = clicked_rows(seed=4)
    clicks = ratings(spark, rows)
    users = recall.index_keys(clicks, "user_id", "als_user_id")
    items = recall.index_keys(clicks, "article_id", "als_article_id")
    rated = recall.indexed_ratings(clicks, users, items)
    model = recall.fit_als(rated, rank=4, max_iter=2, seed=3, blocks=2)
    fixed = model.itemFactors.selectExpr("id AS als_article_id", "features AS factor")
    mine = als.half_step(rated, fixed, "als_user_id", "als_article_id", "clicked", 4, 0.1)
    theirs = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    mine = {r["als_user_id"]: np.array(r["factor"]) for r in mine.collect()}
    assert mine.keys() == theirs.keys()
    assert max(np.abs(mine[k] - theirs[k]).max() for k in mine) < 1e-4  # MLlib keeps floats


def test_no_ratings_nulls_and_bad_arguments(spark):
    rows = [("u1", "a", 1), (None, "a", 1), ("u2", None, 1), ("u3", "b", None)]
    users, items = als.fit(ratings(spark, rows), rank=2, max_iter=1)
    assert [r.user_id for r in users.collect()] == ["u1"] and [r.article_id for r in items.collect()] == ["a"]
    users, items = als.fit(ratings(spark, []), rank=2, max_iter=1)
    assert users.count() == 0 and items.count() == 0
    with pytest.raises(ValueError):
        als.fit(ratings(spark, rows), rank=als.MAX_RANK + 1)


def test_hot_item_is_summed_before_the_shuffle(spark):
    rows = [(f"u{u}", "hot", u % 2) for u in range(400)] + clicked_rows()
    users, items = als.fit(ratings(spark, rows), rank=2, max_iter=1, seed=1)
    want = numpy_als(rows, 2, 1, 0.1, 1)[1]
    got = {r.article_id: np.array(r.factor) for r in items.collect()}
    assert np.abs(got["hot"] - want["hot"]).max() < 1e-6


def factors(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} long, factor array<double>")


def brute(users, items, n):
    out = {}
    for u, x in users:
        scored = []
        for i, y in items:
            s = 0.0
            for a, b in zip(x, y):
                s += a * b
            scored.append((-s, i))
        out[u] = [(i, -s) for s, i in sorted(scored)[:n]]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("user_id", "rank").collect():
        out.setdefault(r.user_id, []).append((r.article_id, r.score))
        assert r["rank"] == len(out[r.user_id])
    return out


@pytest.mark.parametrize("n, block, chunk", [(1, 8, 5), (7, 8, 1000), (7, 16, 9), (20, 1024, 4096)])
@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_top_products_equal_brute_force(spark, n, block, chunk, spread):
    rnd = random.Random(n * 100 + block)
    vector = lambda size: [rnd.gauss(0, 1) * size for _ in range(5)]
    users = [(u, vector(rnd.lognormvariate(0, spread))) for u in range(40)]
    items = [(i, vector(rnd.lognormvariate(0, spread))) for i in range(150)]
    items += [(1000 + i, list(v)) for i, v in items[:30]]  # ties to the smaller id
    users += [(900, [0.0] * 5)]  # scores 0 with every item
    items += [(2000, [0.0] * 5)]
    got = found(topn.top_products(factors(spark, users, "user_id"), factors(spark, items, "article_id"), n,
                                  block_items=block, chunk_users=chunk))
    assert got == brute(users, items, n)


def test_many_ties_at_the_last_place(spark):
    users = [(1, [1.0, 0.0]), (2, [-1.0, 0.0])]
    items = [(i, [1.0, float(i % 7)]) for i in range(60, 0, -1)]
    got = found(topn.top_products(factors(spark, users, "user_id"), factors(spark, items, "article_id"), 5, block_items=8))
    assert got == brute(users, items, 5)


def test_no_cross_join(spark, monkeypatch):
    """Neither the last plan nor those of the tables written on the way."""
    plans = []
    write = topn.materialize
    keep = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df)
    monkeypatch.setattr(topn, "materialize", keep)
    users = factors(spark, [(u, [1.0 + u, 0.5]) for u in range(30)], "user_id")
    items = factors(spark, [(i, [1.0, float(i % 7)]) for i in range(60)], "article_id")
    last = topn.top_products(users, items, 5, block_items=8, chunk_users=7)
    plans.append(last._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 5
    assert not any(w in p for p in plans for w in ("Join Cross", "Join Inner\n", "CartesianProduct", "NestedLoop"))


def test_unusable_rows_and_empty_sides(spark):
    nan, inf = float("nan"), float("inf")
    users = factors(spark, [(1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (None, [1.0, 1.0]), (4, [None, 1.0])], "user_id")
    items = factors(spark, [(1, [3.0, 1.0]), (2, [inf, 1.0]), (3, []), (None, [1.0, 1.0])], "article_id")
    assert found(topn.top_products(users, items, 3)) == {1: [(1, 5.0)]}
    assert topn.top_products(users.limit(0), items, 3).count() == 0
    assert topn.top_products(users, items.limit(0), 3).count() == 0


def test_the_bound_stops_the_scan(spark):
    """Lengths that fall fast: almost no user needs more than the first blocks."""
    rnd = random.Random(2)
    unit = lambda: np.array([rnd.gauss(0, 1) for _ in range(8)])
    items = [(i, (unit() / (1 + i)).tolist()) for i in range(1000)]
    users = [(u, unit().tolist()) for u in range(50)]
    blocks = topn.item_blocks(factors(spark, items, "article_id"), "article_id", "factor", 20).cache()
    assert blocks.count() == 50
    ladder = topn.block_ladder(blocks, 50)
    assert [s for s, _ in ladder] == [1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 50]
    best = brute(users, items, 5)
    rows = [(u, float(np.linalg.norm(v)), best[u][-1][1]) for u, v in users]
    frame = spark.createDataFrame(rows, "u long, length double, score double")
    need = [r[0] for r in frame.select(topn.needed_blocks(frame.length, frame.score, ladder)).collect()]
    assert sum(need) < 0.2 * 50 * len(users)
    # a rung never ends before an item that reaches the score
    tops = {r["_block"]: r["_top"] for r in blocks.collect()}
    for (_, length, score), k in zip(rows, need):
        assert all(length * top < score for b, top in tops.items() if b >= k)


def test_exact_recall_query_against_numpy(spark):
    """The registered query from its clicks: factors, products, ranks."""
    got = entry.queries()["als_recall_exact"](spark, SMALL).collect()
    clicks = [(r.user_id, r.article_id, r.clicked) for r in inputs.clicks(spark, SMALL).collect()]
    users, items = numpy_als(clicks, recall.ALS_RANK, recall.ALS_MAX_ITER, recall.ALS_REG_PARAM, 42)
    lists = {}
    for r in sorted(got, key=lambda r: (r.user_id, r.rec_rank)):
        lists.setdefault(r.user_id, []).append(r)
    assert lists.keys() == users.keys()
    for u, rows in lists.items():
        scores = {i: float(users[u] @ v) for i, v in items.items()}
        assert [r.rec_rank for r in rows] == list(range(1, min(recall.TOP_N, len(items)) + 1))
        assert len({r.article_id for r in rows}) == len(rows)
        assert all(abs(scores[r.article_id] - r.rating) < 2e-6 for r in rows)
        assert np.allclose(sorted(scores.values(), reverse=True)[: len(rows)], [r.rating for r in rows], atol=2e-6)


def test_ratings_of_a_key_lie_in_one_file(spark, monkeypatch):
    """The sums of a key are shuffled once for each task that has ratings of it."""
    kept, write = [], als.materialize
    monkeypatch.setattr(als, "materialize", lambda df: kept.append(write(df)) or kept[-1])
    rows = [(f"u{u}", f"i{i}", 1.0) for u in range(40) for i in range(u % 3, 12, 3)]
    df = spark.createDataFrame(rows, "user_id string, article_id string, clicked double").repartition(4, F.rand(2))
    als.fit(df, rank=2, max_iter=1)
    copies = [k for k in kept if set(k.columns) == {"user_id", "article_id", "_r"}]
    assert [c.count() for c in copies] == [len(rows)] * 2
    for copy, key in zip(copies, ("user_id", "article_id")):
        files = copy.select(key, F.input_file_name().alias("f")).groupBy(key).agg(F.count_distinct("f").alias("n"))
        assert files.agg(F.max("n")).first()[0] == 1


def test_factors_of_the_recall_are_stored_first(spark, monkeypatch):
    """The top-n reads its sides several times: they come from a table, not from clicks."""
    given, top = [], topn.top_products
    monkeypatch.setattr(topn, "top_products", lambda users, items, *a: given.extend([users, items]) or top(users, items, *a))
    entry.queries()["factor_recall"](spark, SMALL)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in given]
    assert len(plans) == 2 and not any("Aggregate" in p or "Join" in p for p in plans)


@pytest.mark.parametrize("columns", [128, 2])
def test_sums_of_vectors(spark, monkeypatch, columns):
    """Vectors of other lengths, nulls in them, null and empty ones; as columns and as rows."""
    monkeypatch.setattr(vec, "MAX_SUM_COLUMNS", columns)
    rows = [("a", [1.0, 2.0, None]), ("a", [0.5]), ("a", None), ("b", []), ("b", None), ("c", [None]), ("d", [1.0]), (None, [2.0, 3.0])]
    df = spark.createDataFrame(rows, "k string, v array<double>").repartition(3)
    got = {r.k: r.v for r in vec.sums(df, "k", "v").collect()}
    assert got == {"a": [1.5, 2.0, None], "c": [None], "d": [1.0], None: [2.0, 3.0]}
    assert vec.sums(df.where("k = 'b'"), "k", "v").collect() == []
    plan = vec.sums(df, "k", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert ("Generate" in plan) == (columns == 2)
