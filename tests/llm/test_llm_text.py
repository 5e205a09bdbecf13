"""Token counts, byte-level BPE, toxicity and importance resampling."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import byte_bpe, importance, queries, token_counts, toxicity
from quire.llm.common import string_buffer

RANKS = public_tokenizers.path(byte_bpe.RANKS)
ODD_TEXT = st.text(st.sampled_from("ab the  \n\t▁'s.,1é中́\x00  <>|"), max_size=60)


@pytest.fixture(scope="module")
def reference_bpe():
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )


@pytest.fixture(scope="module")
def reference_pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(ODD_TEXT, st.text(max_size=40)))
def test_bpe_equals_the_rank_library(reference_bpe, text):
    want = reference_bpe.encode_ordinary(text)
    (packed,) = byte_bpe.pack_texts([text], RANKS, public_tokenizers.PATTERN)
    assert np.frombuffer(packed, "<u4").tolist() == want
    (ids,), (spans,) = byte_bpe.encode_texts([text], RANKS, public_tokenizers.PATTERN)
    assert ids == want and len(spans) == len(ids)
    assert byte_bpe.decode_bytes(ids, RANKS) == text.encode()
    assert "".join(byte_bpe.decode_pieces(ids, RANKS)) == text


def test_bpe_offsets_cover_split_characters():
    text = "a漢 漢"
    (ids,), (spans,) = byte_bpe.encode_texts([text], RANKS, public_tokenizers.PATTERN)
    assert len(ids) > len(text)
    assert {text[a:b] for a, b in spans} <= {"a", "漢", " ", " 漢"}
    assert spans[0] == (0, 1) and max(b for _, b in spans) == len(text)
    # a piece of text comes with the token that completes the character
    pieces = byte_bpe.decode_pieces(ids, RANKS)
    assert "" in pieces and "".join(pieces) == text
    assert byte_bpe.decode_pieces(ids[:2], RANKS)[-1].endswith("�")


def test_bpe_on_odd_rows(spark, odd, empty, reference_bpe):
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    clash = odd.withColumn("ids", F.lit("old")).withColumn("N_TOKENS", F.lit(-1))
    out = byte_bpe.decode(byte_bpe.encode(clash, offsets=True)).collect()
    assert len(out) == len(texts)
    for r in out:
        want = np.array(reference_bpe.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.ids == want.tobytes() and r.n_tokens == len(want) and len(r.spans) == 2 * len(r.ids)
        assert r.decoded == texts[r.doc_id].encode() and r.kept == "extra"
    assert byte_bpe.decode(byte_bpe.encode(empty)).count() == 0


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(ODD_TEXT, st.text(max_size=40)))
def test_counts_equal_the_piece_library(reference_pieces, text):
    counts = token_counts.Counts(public_tokenizers.path(token_counts.MODEL), {"the": 1})
    assert counts.of([text, ""]) == [len(reference_pieces.encode(text)), 0]


def test_counts_on_odd_rows(spark, odd, empty, repeated, reference_pieces):
    for df in (odd, empty, repeated):
        texts = sorted((r.doc_id or -1, len((r.text or "").encode()), len(reference_pieces.encode(r.text or ""))) for r in df.collect())
        found = token_counts.count_tokens(df, ["doc_id"]).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in found) == texts
    # the frequent table changes nothing but the speed
    a = token_counts.count_tokens(odd, ["doc_id"], frequent=[]).collect()
    assert sorted(a) == sorted(token_counts.count_tokens(odd, ["doc_id"]).collect())


def test_frequent_words_are_the_most_frequent(spark):
    df = spark.createDataFrame([(f"the the of x{i}",) for i in range(300)], "text string").repartition(40)
    assert {"the", "of"} <= set(token_counts.frequent_pre_tokens(df, size=2, summary=4))


def test_toxicity_held_out(spark):
    base = "/root/testdata/sf0.1"
    out = queries.op1_toxicity(spark, base)
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "toxic")
    held = out.where("held_out").join(labels, "doc_id").toPandas()
    assert out.count() == 10_000
    assert (held.predicted == held.toxic).mean() > 0.94
    assert held[held.toxic == 0].predicted.mean() < 0.02
    assert held[held.toxic == 1].score.mean() > 10 * held[held.toxic == 0].score.mean()


def test_toxicity_learns_and_takes_odd_rows(spark, odd, empty, repeated):
    rows = [(i, f"{'you idiot' if i % 4 == 0 else 'a calm day'} number {i % 7}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((scored[i] >= 0.5) == (i % 4 == 0) for i in range(150, 200))
    for df in (odd, empty, repeated):
        found = toxicity.score(df, model).collect()
        assert len(found) == df.count() and all(0 <= r.score <= 1 for r in found)
    # a word in a very long text counts as in a short one
    raw, offsets = string_buffer(pa.array([None, "calm " * 90_000 + "idiot", "calm " * 90_000]))
    nothing, bad, good = model.scores(raw, offsets)
    assert bad > good and 0 < nothing < 1


def test_toxicity_without_both_classes(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(0, 0), (3, 0)], "doc_id long, toxic int")
    for labels in (none, one):
        scores = {r.score for r in toxicity.score(odd, toxicity.fit(odd, labels)).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1


def _ngrams(text):
    """Buckets of one text by the definition, token by token."""
    kinds = importance._classes()
    tokens, last = [], None
    for b in text.encode():
        if kinds[b] and kinds[b] == last:
            tokens[-1] += bytes([b])
        elif kinds[b]:
            tokens.append(bytes([b]))
        last = kinds[b]
    return len(tokens) + max(len(tokens) - 1, 0), sum(a == b for a, b in zip(tokens, tokens[1:]))


def test_ngram_buckets_follow_the_definition():
    texts = ["", "one", "The The end!! !!", "é漢 é漢,x", "a " * 300_000, None, "x!y?? ??"]
    raw, offsets = string_buffer(pa.array(texts))
    counts, repeats = np.zeros(len(texts), int), np.zeros(len(texts), int)
    bucket_of_repeat = None
    for owner, buckets in importance.ngram_buckets(raw, offsets):
        counts += np.bincount(owner, minlength=len(texts))
        bucket_of_repeat = 7 << 57 >> (64 - importance.BITS)
        repeats += np.bincount(owner[buckets == bucket_of_repeat], minlength=len(texts))
    want = [_ngrams(t or "") for t in texts]
    assert counts.tolist() == [n for n, _ in want]
    assert repeats.tolist() == [r for _, r in want]


def test_resampling_is_gumbel_top_k(spark):
    rows = [(i, "good plain words here" if i % 3 else "### $$$ %%% ###") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    drawn = importance.resample(docs, labels).withColumn("noise", importance.gumbel("doc_id"))
    out = drawn.toPandas().set_index("doc_id")
    assert out.selected.sum() == 60 and out.selected[out.index % 3 == 0].sum() == 0
    assert np.allclose(out.draw - out.log_weight, out.noise)
    k = importance.resample(docs, labels, k=7).toPandas()
    assert set(k[k.selected].doc_id) == set(k.nlargest(7, "draw").doc_id)
    again = importance.resample(docs, labels, k=7).toPandas()
    assert set(again[again.selected].doc_id) == set(k[k.selected].doc_id)


def test_gumbel_is_standard(spark):
    g = spark.range(20_000).select(importance.gumbel("id").alias("g")).toPandas().g
    assert abs(g.mean() - 0.5772) < 0.03 and abs(g.var() - np.pi**2 / 6) < 0.08


def test_kth_largest(spark):
    values = [0.0, -1e300, 5.0, 5.0, 5.0, 3.5, 3.5000000001, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in range(1, len(values) + 1):
        assert importance.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(df, "x", 0) is None
    assert importance.kth_largest(df.limit(0), "x", 3) is None


def test_resampling_on_odd_rows(spark, odd, empty, repeated):
    labels = spark.createDataFrame([(0, 1), (3, 0), (27, 1), (30, None)], "doc_id long, quality int")
    clash = odd.withColumn("draw", F.lit("old"))
    for df in (clash, empty, repeated):
        out = importance.resample(df, labels, keep=df.columns)
        assert out.count() == df.count()
        assert {"log_weight", "draw", "selected", "kept"} <= set(out.columns)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert importance.resample(odd, none).where("not selected").count() == 0


def test_quality_keeps_good_text(spark):
    base = "/root/testdata/sf0.01"
    out = queries.op7_importance(spark, base)
    labels = spark.read.parquet(f"{base}/labels.parquet")
    found = out.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("selected").cast("int")).alias("share"))
    share = {r.quality: r.share for r in found.collect()}
    assert share[1] > 0.97 and share[0] < 0.1


def test_bpe_query_digests(spark, reference_bpe):
    base = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    for r in queries.op4_byte_bpe(spark, base).collect():
        ids = np.array(reference_bpe.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_count_query(spark, reference_pieces):
    base = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    found = queries.op2_token_counts(spark, base).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(reference_pieces.encode(texts[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 4096)
