"""Segmentation by a lexicon against all paths of small lattices."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import segment, tokens

LEXICON = "word string, weight long, flag string"


def _best(run, words, unknown):
    """The best of all ways to cut a run, each word as long as it can be from the left."""
    ways = []

    def walk(i, weight, cut):
        if i == len(run):
            ways.append((weight, [len(w) for w in cut], cut))
            return
        for j in range(i + 1, len(run) + 1):
            piece = run[i:j]
            if piece in words:
                walk(j, weight + words[piece], [*cut, piece])
            elif j == i + 1:
                walk(j, weight + unknown, [*cut, piece])

    walk(0, 0, [])
    return max(ways)[2]


def test_best_path_is_the_best_of_all():
    rnd = random.Random(5)
    for _ in range(300):
        words = {"".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 5))): -rnd.randrange(1, 6) for _ in range(12)}
        run = "".join(rnd.choice("abéz") for _ in range(rnd.randrange(1, 11)))
        lattice = segment.build_lattice(list(words.items()))
        assert segment.best_path(run, lattice, -7) == _best(run, words, -7)


def test_long_runs_take_linear_time():
    lattice = segment.build_lattice([("ab", -1), ("aba", -2), ("b", -1)])
    assert "".join(segment.best_path("ab" * 200_000, lattice, -9)) == "ab" * 200_000


def _articles(spark, rows):
    return spark.createDataFrame(rows, "article_id long, sentence string")


def test_flags_and_mixed_scripts(spark):
    rows = [("北京", -5, "ns"), ("大学", -5, "n"), ("北京大学", -8, "nt"), ("的", -1, "u"), ("去", -4, "v"), ("云计算", -3, "x")]
    rows += [("京", -9, "n"), ("学生", -6, "n"), (None, 0, "n"), ("大学", -20, "v"), ("的", None, "n")]
    lex = spark.createDataFrame(rows, LEXICON)
    arts = _articles(spark, [(1, "去北京大学的学生<b>x</b>, go to AI云计算"), (2, None), (3, ""), (4, "123 <p>"), (5, "问")])
    every = segment.segment(arts, lex, keep=False)
    got = {}
    for r in sorted(every.collect(), key=lambda r: (r.article_id, r.pos)):
        got.setdefault(r.article_id, []).append((r.word, r.flag))
    assert got[1] == [
        ("去", "v"), ("北京大学", "nt"), ("的", "u"), ("学生", "n"), ("x", "eng"), ("go", "eng"), ("to", "eng"),
        ("AI", "eng"), ("云计算", "x"),
    ]
    assert got[5] == [("问", "")] and set(got) == {1, 5}
    kept = segment.segment(arts, lex, stop_flags=("nt",)).collect()
    assert sorted((r.pos, r.word) for r in kept) == [(3, "学生"), (8, "云计算")]
    # through the tokeniser: the same lexicon with its flags, and the stricter length
    words = lambda **o: sorted(r.word for r in tokens.tokenize(arts, lex, **o).collect())
    assert words() == sorted(["北京大学", "学生", "云计算"])
    assert words(min_other_length=3) == sorted(["北京大学", "云计算"])
    # a lexicon of words alone still restricts letter runs
    assert tokens.tokenize(arts, lex.select("word")).count() == 0


def test_empty_and_oversized_lexicon(spark):
    arts = _articles(spark, [(1, "北京 abc")])
    none = spark.createDataFrame([], LEXICON)
    assert [r.word for r in segment.segment(arts, none, keep=False).orderBy("pos").collect()] == ["北", "京", "abc"]
    assert [r.word for r in segment.segment(arts, none).collect()] == ["abc"]
    lex = spark.createDataFrame([("a", -1, "n"), ("b", -1, "n")], LEXICON)
    with pytest.raises(ValueError):
        segment.segment(arts, lex, max_lexicon_rows=1)


def test_lexicon_of_counts_is_bounded_by_its_share(spark):
    counts = spark.createDataFrame([("aa", 70), ("b", 25), ("c", 5)], "keyword string, count long")
    lex = segment.lexicon_from_counts(counts, F.lit("n"), share=0.1)
    got = {r.word: (r.weight, r.flag) for r in lex.collect()}
    assert got == {"aa": (-357, "n"), "b": (-1387, "n"), "": (-4606, "")}
