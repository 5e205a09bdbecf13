"""Event-time windows over a feed that delivers rows again, late, or never in order.

``channel_windows`` is a stateful stream: a row counts once however often it is
delivered, and each (window, channel) is given once, when the watermark passes
the window's end.  State is bounded by the watermark: the key of a row is
forgotten ``delay`` after its event time, a window when it is given.  A row at or
before the watermark is late and counts nowhere; the watermark is ``delay`` before
the newest event time of all deliveries before this one.

``run_available`` takes what has arrived since the last run and stops, like the
hourly job: progress, state and watermark live in ``checkpoint_location`` (shared
storage on a cluster), and the file sink gives every window exactly once, also
when a run fails and is repeated.  The incremental chain (``incremental``) keeps no
state and drops no late row; this is for figures that must be final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DELAY, WINDOW = "2 days", "1 day"


def channel_windows(feed: DataFrame, delay: str = DELAY, window: str = WINDOW) -> DataFrame:
    """(window_start, channel_name, n_articles, n_chars, newest) from a feed of
    (article_id, content_hash, channel_name, n_chars, time timestamp); rows of one
    article with other content are other rows.  Null times are never late and
    belong to no window."""
    once = feed.withWatermark("time", delay).dropDuplicatesWithinWatermark(["article_id", "content_hash"])
    grouped = once.groupBy(F.window("time", window).alias("w"), "channel_name").agg(
        F.count(F.lit(1)).alias("n_articles"), F.sum("n_chars").alias("n_chars"), F.max("time").alias("newest")
    )
    return grouped.select(F.col("w.start").alias("window_start"), "channel_name", "n_articles", "n_chars", "newest")


def run_available(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    sink_dir: str,
    checkpoint_location: str,
    delay: str = DELAY,
    window: str = WINDOW,
) -> list:
    """Process the files that arrived in ``source_dir``, append the windows that are
    final now to the Parquet table ``sink_dir``, and return the run's progress reports."""
    feed = spark.readStream.schema(schema).parquet(source_dir)
    out = channel_windows(feed, delay, window).writeStream.format("parquet").outputMode("append")
    query = out.option("path", sink_dir).option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress
