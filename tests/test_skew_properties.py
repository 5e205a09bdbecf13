"""Hot keys, the non-broadcast join paths, and property checks of the
tokenizer against an independent Python implementation of the same rule."""

from __future__ import annotations

import math
import random
from collections import Counter

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.functions.windows import as_of_literal
from quire.operators import recall, tfidf, tokens


def py_tokens(text: str) -> list[str]:
    text = regex.sub(r"<[^>\n]*>", "", text)
    out = []
    for w in regex.findall(r"\p{L}+", text):
        if w.isascii():
            if len(w) > 2:
                out.append(w)
        elif len(w) > 1:
            out.append(w)
    return out


ALPHABET = "abcXYZ éüßЖж中文<>/\n\r ,.0123"


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=1, max_size=6))
def test_tokenizer_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "article_id long, sentence string")
    got = {}
    for r in tokens.tokenize(df).orderBy("article_id", "pos").collect():
        got.setdefault(r.article_id, []).append(r.word)
    for i, t in enumerate(texts):
        assert got.get(i, []) == py_tokens(t), t


def corpus(n_docs: int, seed: int = 1):
    rnd = random.Random(seed)
    vocab = [f"w{chr(97 + a)}{chr(97 + b)}x" for a in range(26) for b in range(6)]
    docs = []
    for i in range(n_docs):
        words = ["hotword"] * rnd.randint(1, 30)  # a word in every document
        words += [rnd.choice(vocab) for _ in range(rnd.randint(0, 40))]
        rnd.shuffle(words)
        docs.append((i, " ".join(words)))
    return docs


def py_top20(docs):
    m = len(docs)
    tf = {i: Counter(py_tokens(t)) for i, t in docs}
    df = Counter(w for c in tf.values() for w in c)
    count = Counter()
    for c in tf.values():
        count.update(c)
    order = sorted(count, key=lambda w: (-count[w], w))
    index = {w: k for k, w in enumerate(order)}
    out = {}
    for i, c in tf.items():
        scored = [(c[w] * math.log((m + 1) / (df[w] + 1)), index[w], w) for w in c]
        scored.sort(key=lambda x: (-x[0], x[1]))
        out[i] = [(w, round(s, 4)) for s, _, w in scored[:20]]
    return out


def test_hot_word_and_both_join_paths(spark):
    docs = corpus(300)
    arts = spark.createDataFrame(docs, "article_id long, sentence string").repartition(6)
    tf = tfidf.term_frequency(tokens.tokenize(arts))
    vocab = tfidf.fit_vocabulary(tf, tfidf.document_count(arts))
    hot = vocab.where("keyword = 'hotword'").first()
    assert hot.df == 300 and hot.idf == math.log(301 / 301) and hot["index"] == 0
    expect = py_top20(docs)
    for rows in (0, 10_000):  # sort-merge path, broadcast path
        scored = tfidf.score(tf, vocab, max_broadcast_rows=rows)
        kw = tfidf.top_keywords(scored).collect()
        got = {}
        for r in sorted(kw, key=lambda r: (r.article_id, r.rank)):
            got.setdefault(r.article_id, []).append((r.keyword, r.tfidf))
        assert got == expect


def test_hot_user_clicks(spark):
    rnd = random.Random(2)
    rows = [("hot", str(rnd.randint(0, 50)), rnd.randint(0, 1), "2024-01-10") for _ in range(3000)]
    rows += [(f"u{rnd.randint(0, 200)}", str(rnd.randint(0, 50)), rnd.randint(0, 1), "2024-01-10") for _ in range(4000)]
    beh = spark.createDataFrame(rows, "user_id string, articles string, click_art int, dt string").repartition(5)
    clicks = recall.user_item_clicks(beh, as_of_literal("2024-01-20 00:00:00"))
    expect = {}
    for u, a, c, _ in rows:
        expect[(u, a)] = max(expect.get((u, a), 0), c)
    assert {(r.user_id, r.article_id): r.clicked for r in clicks.collect()} == expect
    users = {r.user_id: r.i for r in recall.index_keys(clicks, "user_id", "i").collect()}
    assert users["hot"] == 0 and sorted(users.values()) == list(range(len(users)))
