"""Table writers.

The reference appends positionally into warehouse tables and upserts into
key-value stores.  Here every table is a Parquet directory written by name:

* ``write_partitioned`` -- overwrite with dynamic partition overwrite: only
  the partitions present in the batch are replaced, so re-running a batch is
  idempotent (a repeated append would duplicate rows);
* ``upsert_keyed`` / ``read_keyed`` -- keyed table of versioned deltas.  An
  upsert appends one delta to the day partitions of its versions and reads or
  rewrites nothing else, so its cost follows the batch, not the store.  A read
  keeps the rows of each key's newest version; ``since`` prunes the days before a
  time bound first (a key's newest version is in the range if any of them is);
* ``compact`` -- folds the deltas of a store into one file set per day;
* ``save_model`` / ``load_*`` -- MLlib model persistence.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.joins import sized_broadcast
from quire.functions.lineage import materialize

# columns of a keyed store that readers never see: partition (day of the
# version), write sequence (decides between equal versions), tombstone
DAY_COL, SEQ_COL, GONE_COL = "_day", "_seq", "_gone"


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when the path does not exist; any other
    problem with it (no schema, damaged files) is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upsert_keyed(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    keys: list[str],
    version_col: str,
    touched: DataFrame | None = None,
    batch: int | None = None,
) -> None:
    """Append ``updates`` as a delta: for each key, all rows of its newest
    version are the ones read back (greatest ``version_col``; of equal versions
    the one written last).  A key may own several rows (the keywords of one
    article): they are replaced together.

    ``touched`` (keys and version) lists every key the batch recomputed: one
    without rows in ``updates`` loses its older rows (a tombstone).  The delta
    is written once, also when it reads the store itself (whose files were listed
    before), and a batch that is written again, after a failure or not, changes nothing.  ``batch`` (see
    ``snapshots``) is the write's sequence number; else it is the clock's."""
    delta = updates.withColumn(GONE_COL, F.lit(False))
    if touched is not None:
        # narrow: keys and versions only
        left = touched.select(*keys, version_col).distinct()
        left = left.join(updates.select(*keys).distinct(), keys, "left_anti")
        delta = delta.unionByName(left.withColumn(GONE_COL, F.lit(True)), allowMissingColumns=True)
    delta = delta.withColumn(DAY_COL, F.to_date(version_col))
    sequence = F.lit(time.time_ns() if batch is None else batch).alias(SEQ_COL, metadata={"keys": keys, "version": version_col})
    # one group of files per day, large days split and small ones packed by AQE;
    # rows in version order, so a time bound skips row groups inside a day
    (
        delta.select("*", sequence)
        .hint("rebalance", F.col(DAY_COL))
        .sortWithinPartitions(DAY_COL, version_col, *keys)
        .write.mode("append")
        .partitionBy(DAY_COL)
        .parquet(path)
    )


def _newest(stored: DataFrame, about: dict) -> DataFrame:
    order = Window.partitionBy(*about["keys"]).orderBy(
        F.col(about["version"]).desc_nulls_last(), F.col(SEQ_COL).desc()
    )
    return stored.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") == 1).drop("_rank")


def _of_batches(stored: DataFrame, batches: DataFrame, how: str) -> DataFrame:
    numbers = sized_broadcast(batches.select(F.col("batch").alias("_batch")).distinct())
    return stored.join(numbers, stored[SEQ_COL] == numbers["_batch"], how)


def read_keyed(
    spark: SparkSession,
    path: str,
    since: Column | None = None,
    only: DataFrame | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """The current rows of a keyed store; with ``since`` those whose version is
    at or after it (days before are not read), with ``only`` (some of the key
    columns) those of its keys, with ``batches`` as these batches left the store.
    All three apply before versions are compared, so no other row is shuffled."""
    stored = spark.read.parquet(path)
    about = stored.schema[SEQ_COL].metadata
    if since is not None:
        stored = stored.where(F.col(DAY_COL) >= F.to_date(since))
    if batches is not None:
        stored = _of_batches(stored, batches, "left_semi")
    if only is not None:
        if not set(only.columns) <= set(about["keys"]):
            raise ValueError(f"{only.columns} are not among the keys {about['keys']}")
        stored = stored.join(only, only.columns, "left_semi")
    rows = _newest(stored, about).where(~F.col(GONE_COL))
    if since is not None:
        rows = rows.where(F.col(about["version"]) >= since)
    return rows.drop(DAY_COL, SEQ_COL, GONE_COL)


def compact(spark: SparkSession, path: str, batches: DataFrame | None = None) -> None:
    """Replace the deltas of every day by the rows that still count.  Days that
    hold nothing current keep their (outdated, never read back) files.  With
    ``batches`` only their rows are folded; those of others, perhaps still being
    written, stay."""
    stored = spark.read.parquet(path)
    about = stored.schema[SEQ_COL].metadata
    if batches is None:
        current = _newest(stored, about)
    else:
        current = _newest(_of_batches(stored, batches, "left_semi"), about)
        current = current.unionByName(_of_batches(stored, batches, "left_anti"))
    current = materialize(current)
    kept = current.withColumn(SEQ_COL, F.col(SEQ_COL).alias(SEQ_COL, metadata=about))
    ordered = kept.hint("rebalance", F.col(DAY_COL)).sortWithinPartitions(
        DAY_COL, about["version"], *about["keys"]
    )
    write_partitioned(ordered, path, [DAY_COL])


def unseen_versions(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    keys: list[str],
    version_col: str,
    hash_col: str,
    batches: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``updates`` that the keyed table at ``path`` (keys, version,
    content hash) does not list yet: newer, or of the same version with other
    content.  All rows when the table does not exist.  Narrow columns only are
    read, and of these only the keys of ``updates`` (read twice) are shuffled."""
    if read_if_exists(spark, path) is None:
        return updates
    stored = read_keyed(spark, path, only=updates.select(*keys).distinct(), batches=batches).select(
        *keys, F.col(version_col).alias("_stored"), F.col(hash_col).alias("_stored_hash")
    )
    newer = F.col(version_col) > F.col("_stored")
    edited = (F.col(version_col) == F.col("_stored")) & (F.col(hash_col) != F.col("_stored_hash"))
    fresh = updates.join(stored, keys, "left").where(F.col("_stored").isNull() | newer | edited)
    return fresh.select(*updates.columns)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
