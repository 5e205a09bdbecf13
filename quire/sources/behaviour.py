"""The behaviour table as a store partitioned by day.

Rows (user_id, articles, click_art, dt) arrive in batches.  A batch is written
under its own name inside the days it has rows of, so late rows join an old
day without touching what is there, and a batch that is delivered or written
again replaces itself: folders are ``dt=.../batch=...``.

A read has the day as a partition column of type string (a value that looks
like a date would be read as one).  A bound on ``dt`` therefore prunes whole
days before any file is opened, also where it comes from a row of another
table (an as-of time): the scan evaluates it when it starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sinks.writers import write_partitioned

BEHAVIOUR_SCHEMA = "user_id string, articles string, click_art int, dt string, batch string"


def store_batch(behaviour: DataFrame, path: str, batch: str) -> None:
    """Write one batch.  Rows without a day are left out: no date limit lets them
    through."""
    rows = behaviour.where(F.col("dt").isNotNull()).withColumn("batch", F.lit(batch))
    # one group of files per day, large days split and small ones packed by AQE
    write_partitioned(rows.hint("rebalance", F.col("dt")), path, ["dt", "batch"])


def read_behaviour(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BEHAVIOUR_SCHEMA).parquet(path).drop("batch")
