"""Driver contract and the oracle gate on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_util import compare, duck

from quire.plans.oracle import ORACLE
from quire.plans.queries import QUERIES

from paths import SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["article_id", "channel_name", "keyword", "tfidf", "article_time", "rank"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # only what is learned goes without an oracle (of the library's own queries)
    assert set(QUERIES) - set(ORACLE) == {"als_recall", "als_recall_exact", "skip_gram_vectors"} and set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("name", ["als_recall", "als_recall_exact", "skip_gram_vectors"])
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SMALL).count() > 0


def test_lsh_recall_against_exact_on_driver_tables(spark):
    exact = {(r.article_id, r.similar_id) for r in entry.queries()["similar_articles_exact"](spark, SMALL).collect()}
    approx = {(r.article_id, r.similar_id) for r in entry.queries()["similar_articles_lsh"](spark, SMALL).collect()}
    assert exact and approx <= exact
    # six tables, buckets of twice the spread of a projection
    assert len(approx) / len(exact) >= 0.9
