"""Plan regression tests: the physical shapes the design relies on."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from quire.operators import tfidf, tokens
from quire.plans import inputs

from paths import SMALL


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # let AQE finalise
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_on_the_data_path(spark, name):
    plan = executed(entry.queries()[name](spark, SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", plan)


def test_top_k_limits_before_the_shuffle(spark):
    plan = executed(entry.queries()["article_keywords_top20"](spark, SMALL))
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_term_frequency_reuses_the_spread(spark):
    tf = tfidf.term_frequency(inputs.article_tokens(spark, SMALL))
    plan = tf._jdf.queryExecution().executedPlan().toString()
    # the only exchange is the spread of the raw rows; the aggregate on
    # (article_id, word) needs none
    assert len(re.findall(r"Exchange ", plan)) == 1


def test_scan_prunes_columns(spark):
    df = inputs.article_tokens(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: (struct<[^\]]*?>)(,|\s|$)", plan).group(1)
    assert "n_chars" not in schema and "text" in schema


def test_score_join_strategy(spark):
    stage = inputs.keyword_stage(spark, SMALL)
    small = executed(tfidf.score(stage.tf, stage.vocabulary))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    big = executed(tfidf.score(stage.tf, stage.vocabulary, max_broadcast_rows=0))
    assert "SortMergeJoin" in big


def test_stop_words_broadcast_is_size_checked(spark):
    toks = inputs.article_tokens(spark, SMALL)
    stops = spark.createDataFrame([("the",)], "word string")
    assert "BroadcastHashJoin" in executed(tokens.remove_stop_words(toks, stops))
    shuffled = executed(tokens.remove_stop_words(toks, stops, max_broadcast_rows=0))
    assert "LeftAnti" in shuffled
