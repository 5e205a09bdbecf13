"""Forest search, presence-mask search and phrase mining against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import forest_search, mask_search, phrases
from quire.llm.queries import ORACLE, op11_forest_search

# --- op11 -------------------------------------------------------------------

VECTORS = "id_ long, embedding array<double>, id string, v string, key int, pid int"


def _odd_vectors(n=240, width=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width))
    x[: n // 3] = x[0]  # a third of all rows are copies
    x[n // 3 : n // 3 + 10] = np.round(x[n // 3 : n // 3 + 10])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(1000, None), (1010, []), (1020, [0.0] * width), (1030, [math.nan] * width), (1040, [1.0, None, 2.0])]
    rows += [(1050, [math.inf] + [0.0] * (width - 1)), (None, [1.0] * width), (1060, [1.0, 2.0]), (1070, [1.0, 2.0, 0.0])]
    rows += [rows[150], (150, [9.0] * width), (120, [8.0] * width)]  # a repeated row, ids of two rows
    return [(i, v, "clash", "clash", 7, 7) for i, v in rows]


def _usable(rows):
    for i, v, *_ in rows:
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            yield i, tuple(v)


def _nearest(rows, k, step):
    points = sorted(set(_usable(rows)))
    width = max(len(v) for _, v in points)
    x = np.array([list(v) + [0.0] * (width - len(v)) for _, v in points])
    out = []
    for q, (i, _) in enumerate(points):
        if i % step:
            continue
        d = forest_search.distances(np.broadcast_to(x[q], x.shape), x)
        order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != q][:k]
        out += [(i, r, points[j][0], float(d[j])) for r, j in enumerate(order, 1)]
    return out


def _forest(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = forest_search.search(df, F.col("id_") % 10 == 0, k, "id_", **options)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    return [tuple(r) for r in found.collect()]


def test_one_leaf_is_exact(spark):
    rows = _odd_vectors()
    got, want = sorted(_forest(spark, rows, leaf_rows=10_000)), sorted(_nearest(rows, 5, 10))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-15, atol=0)


def test_forest_reaches_the_target(spark, monkeypatch):
    rows = _odd_vectors(600, 12, 5)
    want = _nearest(rows, 5, 10)
    got = _forest(spark, rows, leaf_rows=8, salt_rows=4)
    assert len(got) == len(want)
    # the distances found, place by place, are mostly the true ones, and never less
    best = {(q, r): d for q, r, _, d in want}
    pairs = Counter((q, r) for q, r, *_ in want)
    near = [(d, best[q, r]) for q, r, _, d in got if pairs[q, r] == 1]
    assert all(d >= w - 1e-12 for d, w in near)
    assert np.mean([abs(d - w) < 1e-12 for d, w in near]) >= 0.9
    # a task that hands its pairs over early gives the same
    monkeypatch.setattr(forest_search, "HELD_PAIRS", 50)
    assert sorted(_forest(spark, rows, leaf_rows=8, salt_rows=4)) == sorted(got)


def test_fewer_rows_than_neighbours_and_empty(spark):
    rows = [(10, [1.0, 0.0], "", "", 0, 0), (11, [2.0, 0.0], "", "", 0, 0), (20, [1.0, 0.0], "", "", 0, 0)]
    assert sorted(_forest(spark, rows)) == [(10, 1, 20, 0.0), (10, 2, 11, 1.0), (20, 1, 10, 0.0), (20, 2, 11, 1.0)]
    assert _forest(spark, rows[:1]) == [] and _forest(spark, []) == []
    assert _forest(spark, [(10, None, "", "", 0, 0), (20, [0.0], "", "", 0, 0)]) == []


def test_walk_follows_the_measured_order():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 5))
    forest = forest_search.Forest(x, 4, 3, 2.0)
    counts = np.stack([np.bincount(c, minlength=16) for c in forest.place(x).T])
    m = forest.margins(x[:1])[0]
    before = forest.rows_before(m, counts)
    walked = forest.walk(m, counts.tolist(), 10**9)
    assert sorted(walked) == [(t, leaf) for t in range(3) for leaf in range(16) if counts[t][leaf]]
    rows = 0
    for t, leaf in walked:
        assert before[t, leaf] == rows
        rows += counts[t][leaf]


def test_op11_recall_on_driver_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf_dir + "/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = {(q, v): d for q, _, v, d in _nearest(rows, 10, 100)}
    got = {(r.query_id, r.vec_id): r.score for r in op11_forest_search(spark, sf_dir).collect()}
    assert len(set(got) & set(want)) >= 0.9 * len(want) and len(got) == len(want)


# --- op12 -------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def _terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def _ranked(items, docs, k):
    """(item, rank, doc, score); docs are distinct (id, text)."""
    docs = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0))
    held = [(i, Counter(_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_all = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in sorted(set(items), key=repr):
        asked.setdefault(i, Counter()).update(_terms(t))
    out = []
    for i, terms in asked.items():
        scored = []
        for place, (doc, c) in enumerate(held):
            m = 25 + (75 * sum(c.values()) * n_docs) // n_all
            score = 0
            for t, reps in terms.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += reps * w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, place, doc))
        out += [(i, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def _odd_items(rnd):
    long = " ".join(f"w{rnd.randrange(4000)}" for _ in range(150))  # more than 64 terms
    return [
        (1, "one TWO two"), (2, None), (3, ""), (4, long), (4, "w1 w2 w3"), (4, long), (None, "w5 w6 é漢"),
        (5, "é漢é漢 nothing-else"), (6, "..."), (7, "w10 w11 w12 w13 w10"), (8, "absent42"),
    ]


@pytest.mark.parametrize("options", [{}, {"block_documents": 3, "group_terms": 40}])
def test_masks_equal_brute_force(spark, odd, repeated, options):
    items = _odd_items(random.Random(2))
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, score int")
    for docs in (odd, repeated):
        found = mask_search.search(frame, docs, 4, **options)
        assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = {(r.item_id, r.rank): (r.doc_id, r.score) for r in found.collect()}
        want = {(i, r): (d, s) for i, r, d, s in _ranked(items, rows, 4)}
        assert {x: s for x, (_, s) in got.items()} == {x: s for x, (_, s) in want.items()}
        if docs is odd:
            assert got == want


def test_masks_of_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert mask_search.search(items, empty).count() == 0
    assert mask_search.search(items.limit(0), odd).count() == 0
    assert mask_search.search(spark.createDataFrame([(1, None)], "item_id long, text string"), odd).count() == 0


def test_groups_are_skipped_once_safe(spark):
    """Most groups of equal masks are never scored, and the result is still exact."""
    rng = np.random.default_rng(4)
    n, size = 5000, 12
    held = rng.random((n, size)) < np.linspace(0.5, 0.01, size)
    doc, term = np.nonzero(held)
    tf = rng.integers(1, 4, len(doc))
    block = mask_search.Block(
        np.arange(n), np.arange(n), np.ones(n, bool), rng.integers(50, 90, n), doc, term, tf, size, n, 70 * n
    )
    scored = []
    score = block.score
    block.score = lambda item, docs: scored.append(len(docs)) or score(item, docs)
    item = mask_search.Item(1, np.arange(size), np.arange(1, size + 1) * 700, 10)
    block.search(item)
    every = score(item, np.arange(n))
    best = np.lexsort((np.arange(n), -every))[:10]
    assert item.keys.tolist() == best.tolist() and item.scores.tolist() == every[best].tolist()
    assert sum(scored) < n // 5


# --- op13 -------------------------------------------------------------------

PIECES = re.compile(r"[.,;:!?\x0A-\x0D]")
PIECE_WORDS = re.compile(r"[^\x20\x09]+")


def _phrases(rows, min_count, longest, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECES.split((text or "").translate(ASCII_LOWER)):
            w = PIECE_WORDS.findall(piece)
            totals[lang] += len(w)
            for m in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        found = []
        for p, a in often.items():
            if 100 * longer[p] >= 80 * a:
                continue
            cuts = [((2_000_000 * a) // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), a, left, right, totals[lang], score))
        found.sort()
        out += [(lang, r, x[2].decode(), *x[3:]) for r, x in enumerate(found[:top], 1)]
    return sorted(out)


def _phrase_rows(seed=7):
    rnd = random.Random(seed)
    words = ["The", "the", "of", "é漢", "a\x01b", "ab", "abc", "c-d", "'", "x" * 300]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; ", "\r\n", "?", " !"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice(marks) for _ in range(n))
    rows = [(lang, text(rnd.randrange(1, 80))) for lang in ("en", "de", None, "und", "é") for _ in range(30)]
    rows += [("en", "of the line that all share"), ("de", "of the line that all share")] * 12
    rows += [("en", None), (None, None), ("fr", ""), ("fr", " \n."), ("xx", text(20_000)), ("en", rows[0][1])]
    return rows


@pytest.mark.parametrize(
    "options", [{"min_count": 5, "top": 40}, {"min_count": 9, "top": None, "most_words": 7, "most_states": 20}]
)
def test_phrases_equal_brute_force(spark, options):
    rows = _phrase_rows()
    frame = spark.createDataFrame([(x, t, 1, 2) for x, t in rows], "lang string, text string, n int, word int").repartition(3)
    found = phrases.mine(frame, **options)
    got = sorted(tuple(r) for r in found.collect())
    assert got == _phrases(rows, options["min_count"], 4, options["top"]) and got
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_of_nothing(spark):
    schema = "lang string, text string"
    for rows in ([], [("en", None), (None, "")], [("en", "one two three")], [("en", "one. one. one.")]):
        assert phrases.mine(spark.createDataFrame(rows, schema), min_count=2).collect() == []


def test_double_array_holds_exactly_its_phrases():
    rnd = random.Random(3)
    words = 50
    whole = {tuple(rnd.choice([rnd.randrange(4), rnd.randrange(words)]) for _ in range(rnd.randrange(2, 5))) for _ in range(3000)}
    whole |= {p[:m] for p in whole for m in range(2, len(p))}
    rows = np.full((len(whole), 4), phrases.MARK, "<i4")
    for i, p in enumerate(sorted(whole)):
        rows[i, : len(p)] = p
    trie, state = phrases.DoubleArray.build(rows, words)
    assert len(set(state.tolist())) == len(rows) and state.min() >= words
    names = {s: tuple(int(w) for w in r if w >= 0) for s, r in zip(state.tolist(), rows)}
    ids = np.array([rnd.choice([rnd.randrange(4), rnd.randrange(words), phrases.MARK]) for _ in range(20_000)], np.int32)
    total = np.zeros(len(trie.check), np.int64)
    trie.count(ids, 4, total)
    want = Counter()
    for i in range(len(ids)):
        for m in (2, 3, 4):
            p = tuple(int(w) for w in ids[i : i + m])
            if len(p) == m and min(p) >= 0 and p in whole:
                want[p] += 1
    assert {names[s]: int(n) for s, n in enumerate(total) if n} == want


def test_sql_of_the_new_queries_is_registered():
    assert {"op12_mask_search", "op13_phrases"} <= set(ORACLE)
