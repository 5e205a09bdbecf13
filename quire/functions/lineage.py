"""Lineage and input-layout helpers.

``materialize`` writes a DataFrame as a Parquet table under the session's
checkpoint folder (``spark.checkpoint.dir`` on a cluster: shared, reliable
storage) and returns a DataFrame reading it back: later stages that use it
more than once do not recompute it, a lost executor costs a re-read instead
of a re-run of the whole lineage, and the planner sees the table's real size
(a checkpointed RDD would carry only an estimate into join planning).  The
read-back is columnar and pruned to the columns a stage uses.

``spread`` fixes under-partitioned inputs: a file with a single row group is
scanned by one task, which would then run all the text processing alone.  When
the scan has fewer partitions than the cluster's default parallelism, rows are
hash-partitioned by the key (deterministic on retry; the key is the article
id, unique per row of the raw table).  Large inputs already have more splits
than cores and are left alone, so no extra shuffle of the raw data happens at
scale.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from quire.session import checkpoint_dir

# paths written by ``materialize`` inside the innermost open ``scratch_scope``
# of this thread of control (a stream's batches run beside the main thread)
_SCOPE: ContextVar[list[str] | None] = ContextVar("quire_scratch", default=None)


def write_scratch(df: DataFrame, partition_cols: list[str] | None = None) -> str:
    """Write a table under the checkpoint folder; returns its path."""
    folder = checkpoint_dir(df.sparkSession)
    path = os.path.join(folder, "tables", uuid.uuid4().hex)
    df.write.partitionBy(*(partition_cols or [])).parquet(path)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    return df.sparkSession.read.parquet(write_scratch(df))


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table of ``write_scratch`` that no DataFrame reads any more."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables materialized inside the block when it ends (a job's
    intermediates -- the term-frequency table is about the size of the text
    -- are not needed once its outputs are written).  Only for code that
    does not return DataFrames reading them."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for p in paths:
            delete_scratch(spark, p)


def input_partitions(df: DataFrame) -> int:
    """Partition count of the physical plan (no Python RDD is built)."""
    return df._jdf.rdd().getNumPartitions()


def spread(df: DataFrame, key: str) -> DataFrame:
    spark = df.sparkSession
    parallelism = spark.sparkContext.defaultParallelism
    if input_partitions(df) < parallelism:
        return df.repartition(parallelism, key)
    return df


def gather(df: DataFrame, *key: str, times: int = 1) -> DataFrame:
    """All rows of a key in one task, whatever the layout of the input: a table
    exploded from them (the words of the articles) is then grouped by the key and more
    without another shuffle, and what is shuffled here is smaller.  ``times`` as many
    tasks where their rows would not fit."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(times * tasks, *key)
