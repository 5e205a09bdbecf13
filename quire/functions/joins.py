"""Join helpers.

Broadcasting is only done behind a size check.  Data-dependent sides without
an explicit bound are left to AQE, which converts a sort-merge join into a
broadcast join at runtime when the measured shuffle output is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise splits skewed
partitions (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# default row bound for an explicit broadcast (stop-word lists, lexicons)
DEFAULT_BROADCAST_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.  Stops counting after
    ``max_rows + 1`` rows, so the check is cheap on a large input."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is proven small, else ``df``
    unchanged (a shuffle join with AQE skew handling)."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
