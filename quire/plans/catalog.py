"""Temp views over the stored tables, so the pipeline's outputs can be
queried with Spark SQL by name (``select * from article_profile ...``).

A keyed store holds every version that was ever written and the tombstones of
removed keys; its view shows the current rows only (``read_keyed``), without
the store's own columns, and of complete batches only, all stores as of the same
one.  Tables that are replaced as a whole are shown as they
are.  A view resolves its files when it is registered: register again to see
later writes."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quire.plans.jobs import Stores
from quire.sinks.snapshots import committed
from quire.sinks.writers import read_if_exists, read_keyed

# attribute of ``Stores`` -> view name
KEYED_VIEWS = {
    "articles": "article_data",
    "keywords": "tfidf_keywords_values",
    "index_keywords": "pre_tfidf_keywords_values",
    "profiles": "article_profile",
    "article_vectors": "article_vector",
    "similar": "similar_articles",
    "recall": "user_recall",
    "processed": "processed_versions",
}
WHOLE_VIEWS = {"vocabulary": "idf_keywords_values", "word_vectors": "word_vector"}


def register_views(spark: SparkSession, stores: Stores) -> list[str]:
    """Create or replace one temp view per existing stored table; returns
    the view names."""
    names, batches = [], committed(spark, stores.root)
    for attr, name in {**KEYED_VIEWS, **WHOLE_VIEWS}.items():
        path = getattr(stores, attr)
        df = read_if_exists(spark, path)
        if df is None:
            continue
        if attr in KEYED_VIEWS:
            df = read_keyed(spark, path, batches=batches)
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
