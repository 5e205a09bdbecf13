"""Tokenising, vocabulary/idf, TF-IDF top-k: edge rules and an MLlib
cross-check."""

from __future__ import annotations

import math

from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from quire.functions import text
from quire.functions.lineage import gather
from quire.functions.ranking import consecutive_index
from quire.operators import tfidf, tokens


def arts(spark, rows):
    return spark.createDataFrame(
        [(i, "c", s, None) for i, s in rows], "article_id long, channel_name string, sentence string, article_time timestamp_ntz"
    )


def test_keep_rule_and_html(spark):
    a = arts(spark, [(1, "ab abc <b>bold</b> x é éé 12 naïve <a\nb> okay")])
    got = [r.word for r in tokens.tokenize(a).orderBy("pos").collect()]
    # 'ab' is English with 2 letters (dropped), 'x'/'é' single letters dropped,
    # 'éé' kept (non-English, 2 letters), digits are not letters; '<b>' and
    # '</b>' removed; a tag spanning a line break is not a tag
    assert got == ["abc", "bold", "éé", "naïve", "okay"]
    assert "<" not in "".join(got)


def test_stricter_length_variant(spark):
    a = arts(spark, [(1, "éé ééé abc ab")])
    got = [r.word for r in tokens.tokenize(a, min_other_length=3).orderBy("pos").collect()]
    assert got == ["ééé", "abc"]


def test_token_arrays_match_rows(spark):
    a = arts(spark, [(1, "alpha beta <i>gamma</i> beta"), (2, "")])
    arr = {r.article_id: r.words for r in tokens.token_arrays(a).collect()}
    assert arr == {1: ["alpha", "beta", "gamma", "beta"], 2: []}


def test_stop_words_and_lexicon(spark):
    a = arts(spark, [(1, "the cat and the dog")])
    stops = spark.createDataFrame([("the",), ("and",)], "word string")
    kept = [r.word for r in tokens.remove_stop_words(tokens.tokenize(a), stops).orderBy("pos").collect()]
    assert kept == ["cat", "dog"]
    lex = spark.createDataFrame([("dog",)], "word string")
    assert [r.word for r in tokens.tokenize(a, lexicon=lex).collect()] == ["dog"]


def test_stop_words_from_text(spark, scratch):
    p = scratch + "/stop.txt"
    with open(p, "w") as f:
        f.write("  the \n\nand\n")
    assert sorted(r.word for r in tokens.stop_words_from_text(spark, p).collect()) == ["and", "the"]


def test_vocabulary_order_idf_and_ties(spark):
    a = arts(
        spark,
        [
            (1, "common beta alpha alpha"),
            (2, "common beta"),
            (3, "common gamma"),
            (4, ""),  # no token: still counts as a document
        ],
    )
    tf = tfidf.term_frequency(tokens.tokenize(a))
    vocab = {r.keyword: r for r in tfidf.fit_vocabulary(tf, tfidf.document_count(a)).collect()}
    # counts: common 3, alpha 2, beta 2, gamma 1 -> ties by word
    assert [k for k, _ in sorted(vocab.items(), key=lambda kv: kv[1]["index"])] == [
        "common", "alpha", "beta", "gamma"
    ]
    m = 4
    assert math.isclose(vocab["common"].idf, math.log((m + 1) / (3 + 1)))
    assert math.isclose(vocab["gamma"].idf, math.log((m + 1) / (1 + 1)))
    small = tfidf.fit_vocabulary(tf, tfidf.document_count(a), vocab_size=2)
    assert sorted(r.keyword for r in small.collect()) == ["alpha", "common"]
    frac = tfidf.fit_vocabulary(tf, tfidf.document_count(a), min_df=0.5)
    assert sorted(r.keyword for r in frac.collect()) == ["beta", "common"]


def test_word_in_every_document_gets_zero_idf(spark):
    a = arts(spark, [(1, "every one"), (2, "every two")])
    tf = tfidf.term_frequency(tokens.tokenize(a))
    vocab = {r.keyword: r.idf for r in tfidf.fit_vocabulary(tf, tfidf.document_count(a)).collect()}
    assert vocab["every"] == 0.0
    kw = tfidf.top_keywords(tfidf.score(tf, tfidf.fit_vocabulary(tf, tfidf.document_count(a))))
    # zero-weight terms stay and can fill the list
    assert {(r.article_id, r.keyword) for r in kw.collect()} >= {(1, "every"), (2, "every")}


def test_top_k_ties_by_index_and_limit(spark):
    words = " ".join(f"w{chr(97 + i)}{chr(97 + i)}{chr(97 + i)}" for i in range(25))
    a = arts(spark, [(1, words), (2, "zzz")])
    tf = tfidf.term_frequency(tokens.tokenize(a))
    vocab = tfidf.fit_vocabulary(tf, tfidf.document_count(a))
    kw = tfidf.top_keywords(tfidf.score(tf, vocab)).where("article_id = 1").orderBy("rank").collect()
    assert len(kw) == 20
    idx = {r.keyword: r["index"] for r in vocab.collect()}
    # all 25 words tie on tfidf -> the 20 lowest indexes, in index order
    doc_words = [w for w in idx if w != "zzz"]
    assert [r.keyword for r in kw] == sorted(doc_words, key=idx.get)[:20]
    assert [r.rank for r in kw] == list(range(1, 21))


def test_incremental_drops_unknown_words(spark):
    hist = arts(spark, [(1, "alpha beta"), (2, "beta gamma")])
    tf = tfidf.term_frequency(tokens.tokenize(hist))
    vocab = tfidf.fit_vocabulary(tf, tfidf.document_count(hist))
    new = arts(spark, [(3, "alpha unknownword")])
    _, kw = tfidf.keyword_stage(tokens.tokenize(new), new, vocabulary=vocab)
    assert [r.keyword for r in kw.collect()] == ["alpha"]


def test_two_batches_equal_one(spark):
    all_rows = [(i, f"alpha beta{'x' * (i % 3)} gamma{i % 4}x delta") for i in range(12)]
    a = arts(spark, all_rows)
    tf = tfidf.term_frequency(tokens.tokenize(a))
    vocab = tfidf.fit_vocabulary(tf, tfidf.document_count(a))
    _, one = tfidf.keyword_stage(tokens.tokenize(a), a, vocabulary=vocab)
    b1, b2 = arts(spark, all_rows[:5]), arts(spark, all_rows[5:])
    _, k1 = tfidf.keyword_stage(tokens.tokenize(b1), b1, vocabulary=vocab)
    _, k2 = tfidf.keyword_stage(tokens.tokenize(b2), b2, vocabulary=vocab)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(one) == key(k1.unionByName(k2))


def test_matches_mllib_countvectorizer_idf(spark):
    rows = [(i, s) for i, s in enumerate([
        "apple banana apple cherry", "banana durian", "apple elder fig fig fig", "grape", "banana banana"
    ])]
    a = arts(spark, rows)
    tf = tfidf.term_frequency(tokens.tokenize(a))
    vocab = tfidf.fit_vocabulary(tf, tfidf.document_count(a))
    ours = {r.keyword: r.idf for r in vocab.collect()}
    arrays = tokens.token_arrays(a)
    cv = CountVectorizer(inputCol="words", outputCol="tf", vocabSize=2_000_000, minDF=1.0).fit(arrays)
    idf = IDF(inputCol="tf", outputCol="x").fit(cv.transform(arrays))
    theirs = dict(zip(cv.vocabulary, idf.idf.toArray()))
    assert set(ours) == set(theirs)
    assert all(math.isclose(ours[w], theirs[w], abs_tol=1e-12) for w in ours)
    # counts order agrees with MLlib up to ties
    counts = {r.keyword: r["count"] for r in vocab.collect()}
    assert [counts[w] for w in cv.vocabulary] == sorted(counts.values(), reverse=True)


def test_consecutive_index_matches_row_number(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 37).alias("n"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("key")
    ).repartition(7)
    got = consecutive_index(df, [F.col("n").desc(), F.col("key").asc()], "i")
    rows = sorted(got.collect(), key=lambda r: r.i)
    assert [r.i for r in rows] == list(range(5000))
    expect = sorted(((r.n, r.key) for r in rows), key=lambda t: (-t[0], t[1]))
    assert [(r.n, r.key) for r in rows] == expect


def test_vocab_cap_keeps_ties_exactly(spark):
    # counts: aaa 4, bbb 2, ccc 2, ddd 2, eee 1
    a = arts(spark, [(1, "aaa aaa bbb ccc ddd eee"), (2, "aaa aaa bbb ccc ddd")])
    tf = tfidf.term_frequency(tokens.tokenize(a))
    full = {r.keyword: r["index"] for r in tfidf.fit_vocabulary(tf, tfidf.document_count(a)).collect()}
    for cap in (1, 2, 3, 4, 5, 9):
        got = {r.keyword: r["index"] for r in tfidf.fit_vocabulary(tf, tfidf.document_count(a), vocab_size=cap).collect()}
        assert got == {w: i for w, i in full.items() if i < cap}


def test_only_words_that_are_not_frequent_are_shuffled_for_scoring(spark):
    """Over the broadcast bound the first words by index are still broadcast; rows
    of all words, and of none in the vocabulary, score as with one join."""
    rows = [(a, f"w{k}", k + 1) for a in range(4) for k in range(a, 9)] + [(1, "unknown", 2), (2, None, 1)]
    tf = spark.createDataFrame(rows, "article_id long, word string, tf long")
    vocab = spark.createDataFrame([(f"w{k}", k, 0.5 * k) for k in range(9)], "keyword string, index long, idf double")
    whole, split = tfidf.score(tf, vocab), tfidf.score(tf, vocab, max_broadcast_rows=3)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "SortMergeJoin" in plan


def test_words_of_an_article_are_counted_without_a_shuffle(spark):
    """Also when its rows lie in many partitions."""
    rows = [(i % 5, "alpha beta beta") for i in range(40)] + [(None, "gamma"), (None, "gamma")]
    texts = spark.createDataFrame(rows, "article_id long, sentence string").repartition(13)
    counted = tfidf.term_frequency(tokens.tokenize(gather(texts, "article_id")))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "word#" not in "".join(p.split(")")[0] for p in plan.split("hashpartitioning(")[1:])
    want = {(a, w, n) for a in range(5) for w, n in (("alpha", 8), ("beta", 16))} | {(None, "gamma", 2)}
    assert {tuple(r) for r in counted.collect()} == want


def test_scoring_looks_words_up_by_a_long(spark):
    """As a key of the broadcast join a word's string is compared for each row; words
    without an entry and null words find nothing, whatever is broadcast."""
    tf = spark.createDataFrame(
        [(1, "a", 2), (1, "b", 1), (2, "c", 3), (2, "unknown", 1), (None, "a", 1), (3, None, 4)], "article_id long, word string, tf long"
    )
    vocabulary = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 1.5), ("c", 2, 2.0)], "keyword string, index long, idf double")
    want = {(1, "a", 0, 1.0), (1, "b", 1, 1.5), (2, "c", 2, 6.0), (None, "a", 0, 0.5)}
    for rows in (3, 1, 0):
        scored = tfidf.score(tf, vocabulary, rows)
        assert {(r["article_id"], r["keyword"], r["index"], r["tfidf"]) for r in scored.collect()} == want
    plan = tfidf.score(tf, vocabulary, 3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_h#" in plan and "BroadcastHashJoin [word" not in plan


def test_texts_without_a_tag_are_not_searched(spark):
    """Same text with and without; the pattern runs only where a '<' is."""
    rows = spark.createDataFrame([("a <b>c</b> d",), ("a > b",), ("a < b",), ("",), (None,)], "t string")
    stripped = rows.select(text.strip_html(F.col("t")).alias("t"))
    assert [r.t for r in stripped.collect()] == ["a c d", "a > b", "a < b", "", None]
    assert "contains" in stripped._jdf.queryExecution().optimizedPlan().toString().lower()
