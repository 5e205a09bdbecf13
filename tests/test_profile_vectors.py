"""Profile (map + topics) and article vectors."""

from __future__ import annotations

import collections
import datetime as dt
import hashlib
import math
import random
import re

import pytest

from quire.operators import cooccur, profile, vectors
from quire.plans import queries
from quire.plans.oracle import ORACLE

T = dt.datetime(2024, 1, 2, 10, 0)


def keywords(spark, rows):
    return spark.createDataFrame(
        rows, "article_id long, keyword string, tfidf double, rank int"
    )


def articles(spark, rows):
    return spark.createDataFrame(
        [(i, "c", tags, T) for i, tags in rows],
        "article_id long, channel_name string, source_tags string, article_time timestamp_ntz",
    )


@pytest.mark.parametrize(
    "tags, expected",
    [
        (None, ["kb", "ka"]),
        ("unknow", ["kb", "ka"]),
        ("[]", ["kb", "ka"]),
        ("abc", ["kb", "ka"]),  # 3 characters: unusable
        ("abcd", ["abcd"]),  # 4 characters: used
        ('["a", "b"]', ["a", "b"]),
        ('["x y"]', ["xy"]),  # blanks removed
    ],
)
def test_topics_rule(spark, tags, expected):
    kw = keywords(spark, [(1, "ka", 0.5, 2), (1, "kb", 0.9, 1)])
    got = profile.article_profile(kw, articles(spark, [(1, tags)])).collect()
    assert len(got) == 1
    assert got[0].topics == expected
    assert got[0].keyword == {"kb": 0.9, "ka": 0.5}


def test_profile_needs_keywords_and_one_row_per_article(spark):
    kw = keywords(spark, [(1, "ka", 0.5, 1)])
    arts = articles(spark, [(1, None), (2, None)])
    prof = profile.article_profile(kw, arts)
    assert [r.article_id for r in prof.collect()] == [1]
    rows = profile.explode_profile(prof).collect()
    assert [(r.keyword, r.weight) for r in rows] == [("ka", 0.5)]


def test_article_vector_set_mean(spark):
    rows = spark.createDataFrame(
        [
            (1, "c", "w1", 2.0, T),
            (1, "c", "w2", 2.0, T),  # same weighted vector as w1: counted once
            (1, "c", "w3", 1.0, T),
            (2, "c", "missing", 1.0, T),  # no vector: article 2 drops out
        ],
        "article_id long, channel_name string, keyword string, weight double, article_time timestamp_ntz",
    )
    wv = spark.createDataFrame(
        [("w1", [1.0, 0.0]), ("w2", [1.0, 0.0]), ("w3", [0.0, 4.0])], "word string, vector array<double>"
    )
    got = vectors.article_vectors(rows, wv).collect()
    assert len(got) == 1 and got[0].article_id == 1
    # set {(2,0), (0,4)} -> mean (1, 2)
    assert got[0].articlevector == [1.0, 2.0]


def test_word2vec_invariants(spark):
    arrays = spark.createDataFrame(
        [(i, ["alpha", "beta", "gamma", "delta"][i % 4 :] + ["alpha", "beta"]) for i in range(40)],
        "article_id long, words array<string>",
    )
    m1 = vectors.fit_word2vec(arrays, vector_size=8, min_count=3, seed=7, num_partitions=1)
    m2 = vectors.fit_word2vec(arrays, vector_size=8, min_count=3, seed=7, num_partitions=1)
    t1 = {r.word: r.vector for r in vectors.word_vector_table(m1).collect()}
    t2 = {r.word: r.vector for r in vectors.word_vector_table(m2).collect()}
    assert set(t1) == {"alpha", "beta", "gamma", "delta"}
    assert all(len(v) == 8 for v in t1.values())
    assert t1 == t2  # same seed, same vectors


def test_duplicate_keyword_last_wins(spark):
    # a stored keyword table may hold one keyword twice for an article
    kw = keywords(spark, [(1, "ka", 0.5, 1), (1, "ka", 0.2, 2)])
    got = profile.article_profile(kw, articles(spark, [(1, None)])).collect()
    assert got[0].keyword == {"ka": 0.2}


@pytest.mark.parametrize("max_broadcast", [500_000, 3, 0])
def test_cooccurrence_vectors_equal_a_plain_version(spark, max_broadcast):
    """Words below the count, nulls, words beside themselves; the vocabulary whole,
    in part and not at all broadcast."""
    rnd = random.Random(4)
    texts = [[rnd.choice("aaaabbbccdefgh") for _ in range(rnd.randrange(12))] for _ in range(40)]
    texts += [None, [], ["once", "a", "a"], ["b", None, "c", "twice", "d"], ["twice"]]
    counts = collections.Counter(w for t in texts for w in t or [] if w is not None)
    pairs = collections.Counter()
    for t in texts:
        for i, x in enumerate(t or []):
            for y in t[i + 1 : i + 4]:
                if counts[x] >= 3 and counts[y] >= 3:
                    pairs[x, y] += 1
                    pairs[y, x] += 1
    total = collections.Counter()
    for (x, _), n in pairs.items():
        total[x] += n
    every, size = sum(total.values()), 40
    bits = {w: sum(int(hashlib.md5(f"{w}#0".encode()).hexdigest()[8 * k : 8 * k + 8], 16) << 32 * k for k in range(4)) for w in counts}
    want = {}
    for (x, y), n in pairs.items():
        pmi = math.log(n * every / (total[x] * total[y]))
        if pmi > 0:
            signs = [1 - 2 * (bits[y] >> d & 1) for d in range(size)]
            want[x] = [v + pmi * s for v, s in zip(want.get(x, [0.0] * size), signs)]
    df = spark.createDataFrame([(t,) for t in texts], "words array<string>").repartition(3)
    got = {r.word: list(r.vector) for r in vectors.cooccurrence_vectors(df, size, 3, 3, max_broadcast).collect()}
    assert set(got) == set(want) and "twice" not in got
    for w in want:
        assert got[w] == pytest.approx(want[w], abs=1e-9), w


def test_word_pairs_are_counted_as_numbers(spark):
    """Their strings are no key of any aggregate, whatever is broadcast."""
    df = spark.createDataFrame([(list("abcab"),)], "words array<string>")
    for max_broadcast in (10, 2, 0):
        words = cooccur.vocabulary(df, 1)
        pairs = cooccur.pair_counts(df, words, 5, max_broadcast)
        plan = pairs._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [" in plan and not re.search(r"Aggregate \[[^\]]*_[ab]#", plan)
        assert {(r.a, r.b): r.n for r in pairs.collect()} == {(0, 0): 1, (0, 1): 4, (0, 2): 2, (1, 1): 1, (1, 2): 2}


@pytest.mark.parametrize("max_broadcast", [100, 10])
def test_pairs_of_a_long_text_are_streamed(spark, max_broadcast):
    """A text of several batches is never one row, and no pair is lost between them."""
    rnd = random.Random(2)
    texts = [[rnd.choice("abcdefghijklmnopqrstuvwxyz") + rnd.choice("xy") for _ in range(n)] for n in (23_000, 3, 1, 12_000)]
    df = spark.createDataFrame([(t,) for t in texts], "words array<string>").coalesce(1)
    words = cooccur.vocabulary(df, 1)
    pairs = cooccur.pair_counts(df, words, 5, max_broadcast)
    assert "collect_list" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    number = {r.word: r.id for r in words.collect()}
    want = collections.Counter()
    for t in texts:
        for i, x in enumerate(t):
            for y in t[i + 1 : i + 6]:
                want[tuple(sorted((number[x], number[y])))] += 1
    assert {(r.a, r.b): r.n for r in pairs.collect()} == want


def test_registered_word_vectors_have_the_size_of_the_full_build():
    assert queries.WORD_VECTOR_SIZE == vectors.FULL_BUILD_SIZE == 200
    assert "range(200)" in ORACLE["word_vectors"]
