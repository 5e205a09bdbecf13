"""Similar pairs kept on both sides.

The store holds a pair as two rows, (a, b) and (b, a), so it is its own reverse
index: the rows of an article name every article that lists it.  When articles
are computed again, each pair they had or have now is replaced in both lists;
pairs that are no longer found leave both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.joins import sized_broadcast
from quire.functions.lineage import materialize
from quire.sinks.writers import read_if_exists, read_keyed

PAIR_KEYS = ["article_id", "similar_id"]


def mirrored(pairs: DataFrame) -> DataFrame:
    """Each pair in both directions, once.  It is made distinct in one of them, so half
    of the rows are shuffled."""
    a, b = (F.col(c) for c in PAIR_KEYS)
    turned = F.coalesce((b < a) | (a.isNull() & b.isNotNull()), F.lit(False))
    once = pairs.withColumns({"article_id": F.when(turned, b).otherwise(a), "similar_id": F.when(turned, a).otherwise(b)})
    there = F.struct(*[F.col(c) for c in pairs.columns])
    swapped = {"article_id": "similar_id", "similar_id": "article_id"}
    back = F.struct(*[F.col(swapped.get(c, c)).alias(c) for c in pairs.columns])
    both = F.when(a.eqNullSafe(b), F.array(there)).otherwise(F.array(there, back))
    return once.dropDuplicates(PAIR_KEYS).select(F.explode(both).alias("_p")).select("_p.*")


def both_sides(
    spark: SparkSession,
    pairs: DataFrame,
    path: str,
    touched: DataFrame,
    version: Column,
    version_col: str = "computed_at",
    batches: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, replaced) to hand to ``upsert_keyed`` with ``PAIR_KEYS``: ``pairs`` (article_id,
    similar_id, distance) are all pairs found for the articles in ``touched``
    (article_id).  Versions rise from batch to batch.  ``replaced`` are the pairs that the
    store has of touched articles (those in ``rows`` need no mention); only these are
    shuffled, not the store, while the articles are few enough to broadcast."""
    rows = mirrored(pairs).withColumn(version_col, version)
    if read_if_exists(spark, path) is None:
        return rows, rows.select(*PAIR_KEYS, version_col).limit(0)
    only = sized_broadcast(materialize(touched.select("article_id").distinct()))
    held = read_keyed(spark, path, only=only, batches=batches)
    return rows, mirrored(held.select(*PAIR_KEYS)).withColumn(version_col, version)
