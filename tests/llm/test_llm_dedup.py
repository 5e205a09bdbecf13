"""Suffix-array dedup, the Jaccard join, near-duplicate vectors and top-k search."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import embedding_dedup, jaccard_join, suffix_dedup, topk_search
from quire.llm.common import connected_components


def _route_and_scan(docs: dict[int, bytes], parts: int, rnd: random.Random):
    """Spans and groups as the two Spark stages make them, on three blocks."""
    ids = sorted(docs)
    got = {d: np.zeros(len(docs[d]), bool) for d in ids}
    routed = {p: [] for p in range(parts)}
    for block in (ids[i::3] for i in range(3)):
        rnd.shuffle(block)
        raw = np.frombuffer(b"".join(docs[d] for d in block), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(docs[d]) for d in block])]).astype(np.int64)
        known, packed = suffix_dedup.route_block(np.array(block, np.int64), raw, offsets, parts)
        for r in known.to_pylist() if known else []:
            got[r["doc"]][r["start"] : r["start"] + r["length"]] = True
        for p, b in packed:
            routed[p].append(b)
    groups = {}
    for blocks in filter(None, routed.values()):
        *columns, data = map(list, zip(*map(suffix_dedup.unpack, blocks)))
        doc, lo, length, at = map(np.concatenate, columns)
        array = suffix_dedup.SuffixArray(doc, lo, length, at, np.cumsum(length) - length, data)
        for r in array.repeated_spans().to_pylist():
            got[r["doc"]][r["start"] : r["start"] + r["length"]] = True
        for b in array.all_groups():
            for r in b.to_pylist():
                groups.setdefault(r["grp"], []).append(r)
    return got, groups


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_equals_brute_force(seed, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(suffix_dedup, "CHUNK", rnd.choice([1 << 18, 97, 301]))
    for letters in (b"ab", b"abc\x00", b"a", bytes(range(97, 123))):
        passages = [bytes(rnd.choice(letters) for _ in range(rnd.randrange(60, 400))) for _ in range(5)]
        docs = {}
        for d in rnd.sample(range(-5, 1000), 12):
            body = b""
            for _ in range(rnd.randrange(0, 6)):
                x = rnd.choice(passages)
                x = x[rnd.randrange(len(x)) :] if rnd.random() < 0.5 else x
                body += x + bytes(rnd.choice(letters) for _ in range(rnd.randrange(0, 40)))
            docs[d] = body
        seen = set()
        got, groups = _route_and_scan(docs, 3, rnd)
        for d in sorted(docs):
            want = np.zeros(len(docs[d]), bool)
            for p in range(len(docs[d]) - 99):
                if (s := docs[d][p : p + 100]) in seen:
                    want[p : p + 100] = True
                seen.add(docs[d][p : p + 100])
            assert np.array_equal(got[d], want)
        for members in groups.values():
            strings = {docs[r["doc"]][r["start"] : r["start"] + r["length"]] for r in members}
            assert len(strings) == 1 and len(strings.pop()) >= 100 and len(members) > 1
            assert any(r["earliest"] for r in members)


def test_lcp_intervals():
    # prefixes of: aab aac ab b | common 2, 1, 0
    assert suffix_dedup.lcp_intervals([0, 2, 1, 0], 1) == [(2, 0, 1), (1, 0, 2)]
    assert suffix_dedup.lcp_intervals([0, 2, 2, 0, 5], 2) == [(2, 0, 2), (5, 3, 4)]
    assert suffix_dedup.lcp_intervals([], 1) == [] and suffix_dedup.lcp_intervals([0], 1) == []


def _check_removal(out, docs):
    want = brute.repeated_bytes(docs)
    assert len(out) == len(docs)
    for r in out:
        body, gone = want[r.doc_id]
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(body), sum(gone), spans)
        assert bytes(r.kept) == bytes(b for b, g in zip(body, gone) if not g)


def test_removal_on_odd_rows(spark, odd, empty):
    docs = {r.doc_id: r.text for r in odd.collect()}
    out = suffix_dedup.remove_repeats(odd.withColumn("n_bytes", F.lit("old")))
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "score", "n_bytes", "n_removed", "n_spans", "kept"]
    _check_removal(out.collect(), docs)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_removal_with_repeated_rows_and_ids(spark, repeated):
    rows = sorted({(r.doc_id is not None, r.doc_id or 0, r.text or "") for r in repeated.collect()})
    want = brute.repeated_bytes({i: t for i, (_, _, t) in enumerate(rows)})
    counts = sorted(
        (k or 0, len(want[i][0]), sum(want[i][1]))
        for i, (known, k, t) in enumerate(rows)
        for _ in range(repeated.where(F.coalesce("text", F.lit("")) == t).where(F.col("doc_id").eqNullSafe(k if known else None)).count())
    )
    out = suffix_dedup.remove_repeats(repeated).collect()
    # of rows under one id the order is that of a hash of the text: compare totals
    assert sorted((r.doc_id or 0, r.n_bytes) for r in out) == sorted(c[:2] for c in counts)
    assert len(out) == repeated.count()


@pytest.mark.parametrize("parts", [1, 8])
def test_repeated_rows_do_not_erase_themselves(spark, parts):
    """Copies that meet in one block and copies in different blocks."""
    rnd = random.Random(11)
    passage = brute.prose(rnd, 40)
    texts = {i: f"{brute.prose(rnd, 30)} {passage} {brute.prose(rnd, 30)}" for i in range(1, 5)}
    texts[5] = brute.prose(rnd, 60)
    rows = [(i, t) for i, t in texts.items() for _ in range(1 if i == 2 else 3)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    want = brute.repeated_bytes(texts)
    out = suffix_dedup.remove_repeats(docs).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows)
    for r in out:
        body, gone = want[r.doc_id]
        assert (r.n_bytes, r.n_removed) == (len(body), sum(gone))
        assert bytes(r.kept) == bytes(b for b, g in zip(body, gone) if not g)
    assert sum(map(sum, (g for _, g in want.values()))) > 0
    found = [(r.grp, r.key, r.start) for r in suffix_dedup.maximal_repeats(docs).collect()]
    assert len(found) == len(set(found)) and {k for _, k, _ in found} == {0, 1, 2, 3}  # keys are ranks


def test_maximal_repeats_have_all_occurrences(spark):
    passage = brute.prose(random.Random(3), 60)
    rows = [(i, f"{brute.prose(random.Random(i), 20)} {passage} {brute.prose(random.Random(-i - 1), 9)}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.maximal_repeats(docs).toPandas()
    texts = dict(rows)
    for _, g in found.groupby("grp"):
        assert len({texts[k].encode()[s : s + n] for k, s, n in zip(g.key, g.start, g.length)}) == 1
    covered = {k: set() for k in texts}
    for k, s, n in zip(found.key, found.start, found.length):
        covered[k] |= set(range(s, s + n))
    for k, t in texts.items():
        at = t.index(passage)
        assert set(range(at, at + len(passage))) <= covered[k]


def test_text_of_what_is_kept_is_valid(spark):
    rows = [(0, "漢" * 60), (1, "x" + "漢" * 40 + "y")]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), as_text=True).collect()
    assert all("�" not in r.kept for r in out)


# --- Jaccard join ---------------------------------------------------------------


def _sets(rnd, n, size):
    tokens, cuts = [], [0]
    for _ in range(n):
        base = rnd.randrange(4)
        s = {hash((base, i)) & (2**62 - 1) for i in range(size) if rnd.random() < 0.93}
        s |= {rnd.getrandbits(60) for _ in range(rnd.randrange(0, size // 8 + 1))}
        tokens += sorted(s)
        cuts.append(len(tokens))
    return np.array(tokens, np.int64), np.array(cuts)


@pytest.mark.parametrize("bits", [64, 8192])
@pytest.mark.parametrize("across", [False, True])
def test_signature_trees_lose_no_link(bits, across, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SIGNATURE_BITS", bits)
    rnd = random.Random(bits)
    for size in (3, 12, 90):
        tokens, cuts = _sets(rnd, 150, size)
        sets = [set(tokens[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
        side = np.array([rnd.randrange(2) for _ in sets])
        links = [
            (i, j)
            for i in range(len(sets))
            for j in range(i)
            if (not across or side[i] != side[j]) and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
        ]
        a, b = jaccard_join.block_links(tokens, cuts, np.arange(len(sets)), side if across else None)
        pairs = list(zip(a.tolist(), b.tolist()))
        assert {tuple(sorted(p, reverse=True)) for p in pairs} <= set(links)
        assert brute.components(range(len(sets)), pairs) == brute.components(range(len(sets)), links)
        assert len(pairs) < len(sets)  # a forest, not all pairs


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_join_equals_brute_force(spark, odd, words, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 3)  # large clusters meet across blocks
    docs = {r.doc_id: r.text for r in odd.collect()}
    sizes, want = brute.jaccard_components(docs, words, percent)
    out = jaccard_join.join(odd, words=words, percent=percent).collect()
    assert {r.doc_id: r.n_shingles for r in out} == sizes
    assert {r.doc_id: r.component_id for r in out} == want
    assert len(set(want.values())) < len(want)
    kept = jaccard_join.first_of_groups(odd, words=words, percent=percent)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == odd.columns


def test_join_takes_odd_tables(spark, empty, repeated):
    assert jaccard_join.join(empty).count() == 0
    assert jaccard_join.first_of_groups(empty).count() == 0
    out = jaccard_join.join(repeated)
    assert out.count() == repeated.count()
    copies = out.groupBy("doc_id", "n_shingles").agg(F.count_distinct("component_id").alias("n"))
    assert copies.where("n > 1").count() == 0
    kept = jaccard_join.first_of_groups(repeated)
    assert kept.dropDuplicates(["doc_id", "text"]).count() == kept.count()


def test_hot_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 16)
    rnd = random.Random(8)
    base = brute.prose(rnd, 80).split(" ")
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rnd.randrange(1, 4)):
            w[rnd.randrange(80)] = f"n{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, brute.prose(rnd, 80)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, want = brute.jaccard_components(dict(rows), 4, 85)
    assert {r.doc_id: r.component_id for r in jaccard_join.join(docs).collect()} == want


# --- vectors ----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score string"


def _odd_vectors():
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(40, 12))
    near = base[:20] + rnd.normal(size=(20, 12)) * 0.12
    rows = [(i, [float(x) for x in v], 0, "x") for i, v in enumerate([*base, *near, *base[:5], *(3 * base[5:9])])]
    n = len(rows)
    rows += [(n, None, 0, "x"), (n + 1, [], 0, "x"), (n + 2, [0.0] * 12, 0, "x"), (n + 3, [1.0, None], 0, "x")]
    rows += [(n + 4, [float("nan")] * 12, 0, "x"), (n + 5, [float("inf")] + [1.0] * 11, 0, "x"), (n + 6, [1.0, 2.0], 0, "x")]
    rows += [(n + 7, [2.0, 4.0], 0, "x"), (n + 8, [1e-30] * 12, 0, "x"), (n + 9, [1e30] * 12, 0, "x")]
    return rows


def _usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def test_near_vectors_equal_brute_force(spark):
    rows = _odd_vectors()
    df = spark.createDataFrame(rows, VECTORS)
    links = []
    for i, v, *_ in rows:
        for j, w, *_ in rows:
            if i < j and _usable(v) and _usable(w) and len(v) == len(w) and any(v) and any(w):
                a, b = np.float32(v).astype(float), np.float32(w).astype(float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.9:
                    links.append((i, j))
    want = brute.components([r[0] for r in rows], links)
    out = embedding_dedup.near_duplicates(df).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.n_links == sum(r.vec_id in p for p in links)
        assert (r.component_id, r.kept) == (want[r.vec_id], want[r.vec_id] == r.vec_id)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_hot_buckets_are_cut_and_counted_once(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 20)
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=32)
    x = np.concatenate([base + rnd.normal(size=(150, 32)) * 0.25, rnd.normal(size=(50, 32)), np.tile(base, (40, 1))])
    df = spark.createDataFrame([(i, [float(y) for y in v], 0, "") for i, v in enumerate(x)], VECTORS)
    u = np.float32(x).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    want = linked.sum(1) - 1
    got = np.array([r.n_links for r in embedding_dedup.near_duplicates(df).orderBy("vec_id").collect()])
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum()


def test_recall_at_the_threshold():
    rnd = np.random.default_rng(6)
    u = rnd.normal(size=(1500, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rnd.normal(size=u.shape)
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    a, b = embedding_dedup.codes(u), embedding_dedup.codes(0.9 * u + np.sqrt(1 - 0.81) * w)
    met = ((a == b[:, :, :1]) | (b == a[:, :, :1])).any((1, 2))
    assert met.mean() > 0.99


def test_repeated_vectors_are_one(spark):
    rows = [(1, [1.0, 0.0], 0, ""), (1, [1.0, 0.0], 0, ""), (2, [1.0, 0.01], 0, ""), (2, [0.0, 1.0], 0, ""), (None, [0.0, 1.0], 0, "")]
    out = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in out) == [(0, 1), (1, 1), (1, 1), (2, 1), (2, 1)]


def _brute_search(rows, k):
    q = {i: np.floor(np.float32(v).astype(float) * 64) for i, v, *_ in rows if i is not None and _usable(v)}
    out = []
    for a in (i for i in q if i % 20 == 0):
        scored = []
        for b in q:
            m = min(len(q[a]), len(q[b]))
            if a != b:
                scored.append((-sum(int(x) * int(y) for x, y in zip(q[a][:m], q[b][:m])), b))
        out += [(a, r + 1, b, -s) for r, (s, b) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 256])
def test_search_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", block)
    monkeypatch.setattr(topk_search, "ROUND_VALUES", 40)  # several rounds
    rows = [r for r in _odd_vectors() if not r[1] or 1e30 not in r[1]]
    rows += [(300 + i, [0.5] * 12, 0, "x") for i in range(30)]  # ties
    out = topk_search.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted(map(tuple, out)) == _brute_search(rows, 20)


def test_search_with_scores_beyond_doubles(spark):
    rows = [(i, [float(2.0**23 + i), float(2.0**22 - i)], 0, "") for i in range(25)] + [(40, [-(2.0**23), 1.0], 0, "")]
    out = topk_search.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, 5).collect()
    assert sorted(map(tuple, out)) == _brute_search(rows, 5)


def test_search_of_odd_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert topk_search.search(none, F.col("vec_id") % 20 == 0).count() == 0
    rows = [(0, [1.0, 2.0], 0, ""), (0, [1.0, 2.0], 0, ""), (5, [3.0], 0, ""), (None, [9.0], 0, "")]
    out = topk_search.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in out] == [(0, 1, 5, 64 * 192)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(200)] + [(7, 7)]
    out = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    found = {r.node: r.component for r in out.collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[1000 + i] == 1000 for i in range(200))
