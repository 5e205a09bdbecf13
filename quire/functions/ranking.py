"""Ranking helpers that stay distributed.

``consecutive_index`` gives every row its 0-based position in a total order
(the vocabulary index, the id maps for ALS).  A ``row_number()`` over an
un-partitioned window would pull the whole table into one task; instead the
rows are range-partitioned by a global sort, tagged with
``monotonically_increasing_id`` (partition id in the upper bits, row number
within the partition in the lower 33 bits), and each partition's starting
offset comes from a per-partition count -- a table with one row per
partition, which is the only thing that is broadcast.

The tagged rows are materialized into the session's checkpoint folder, so the
ids are computed once and survive executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.lineage import materialize

_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def consecutive_index(
    df: DataFrame,
    order: list[Column],
    index_col: str = "index",
    checkpoint: bool = True,
) -> DataFrame:
    """Append ``index_col`` = 0-based rank of each row under ``order``.

    ``order`` must be a total order (break ties on a unique key) so the index
    is deterministic.
    """
    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        tagged = materialize(tagged)
    part = F.shiftright(F.col("_mid"), _ROW_BITS)
    counts = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition of the sort: bounded by the partition count
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    out = tagged.join(F.broadcast(offsets), part == F.col("_part")).withColumn(
        index_col,
        F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_ROW_MASK)),
    )
    return out.drop("_mid", "_part", "_offset")


def top_k_per_group(
    df: DataFrame, group: str | list[str], order: list[Column], k: int, rank_col: str = "rank"
) -> DataFrame:
    """Rows ranked 1..k inside each group.  Spark plans this as a
    ``WindowGroupLimit`` below the shuffle, so each map task sends at most k
    rows per group."""
    keys = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
