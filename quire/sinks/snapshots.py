"""Batches of writes to several keyed stores that readers see whole or not at all.

A batch is a number, taken when it begins (``begin``) and written with every
row it stores (``upsert_keyed(..., batch=...)``).  Its last write is one row in
the manifest of the stores' root (``commit``).  ``committed`` lists the batches
a reader may see; ``read_keyed(..., batches=...)`` keeps their rows only.  So a
reader between two writes of a batch sees every store as the last complete
batch left it, and what a failed batch wrote is never seen: its repetition is a
batch of its own.  ``upto`` reads the stores as they were after an earlier
batch, as long as they are not compacted.

The manifest is an ordinary Parquet table of one row a batch, appended by Spark's committer (a
row is there or not).  Of equal versions the batch that began last counts, as
with plain upserts.  A root without a manifest has no batches: all rows
of its stores are seen.  Once it has one, rows written without a batch are not.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sinks.writers import read_if_exists

MANIFEST = "_batches"


def _row(spark: SparkSession, batch: int) -> DataFrame:
    return spark.range(1).select(F.lit(batch).cast("long").alias("batch"))


def _manifest(root: str) -> str:
    return os.path.join(root, MANIFEST)


def begin(spark: SparkSession, root: str) -> int:
    """The number of a new batch; from the first one on the root has a manifest."""
    if read_if_exists(spark, _manifest(root)) is None:
        _row(spark, 0).where(F.lit(False)).write.mode("append").parquet(_manifest(root))
    return time.time_ns()


def commit(spark: SparkSession, root: str, batch: int) -> None:
    _row(spark, batch).coalesce(1).write.mode("append").parquet(_manifest(root))


@contextmanager
def batch_of(spark: SparkSession, root: str) -> Iterator[int]:
    """A batch that is committed when the block ends without an error."""
    batch = begin(spark, root)
    yield batch
    commit(spark, root, batch)


def committed(
    spark: SparkSession, root: str, own: int | None = None, upto: int | None = None
) -> DataFrame | None:
    """(batch): the complete batches, those begun up to ``upto`` if given, and
    the reader's ``own``; None if the root has no manifest."""
    rows = read_if_exists(spark, _manifest(root))
    if rows is None:
        return None
    if upto is not None:
        rows = rows.where(F.col("batch") <= upto)
    return rows if own is None else rows.unionByName(_row(spark, own))
