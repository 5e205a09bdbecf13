"""SparkSession construction and session-level settings.

On a cluster the session is created by the platform; ``configure`` only sets
what the pipeline relies on for correct results (UTC, map-key policy) and for
AQE.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session and
only falls back to a local scratch folder when that is unset (tests, local
runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline needs regardless of where it runs.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # the reference builds maps with dict(zip(...)): the last duplicate wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# target bytes per task: shuffle partitions and scan splits both aim here,
# which keeps a task's hash tables and sort buffers well inside executor memory
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input on
    ``total_cores`` cores.

    The initial shuffle partition count is sized so that even the largest
    intermediate (term frequencies, about the size of the text) splits into
    ~128 MB pieces, and never below three waves of tasks; AQE then coalesces
    small partitions and splits skewed ones at runtime.  Text files are
    read in 128 MB splits (a row group is the smallest unit)."""
    parts = max(3 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(8 * 1024 * 1024),
    }


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        for key, value in scale_conf(input_bytes, cores).items():
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "quire",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session.  On a cluster use the platform's session and call
    ``configure`` instead."""
    master = master or os.environ.get("QUIRE_MASTER", "local[8]")
    cores = master[master.find("[") + 1 : master.find("]")] if "[" in master else "8"
    parts = shuffle_partitions or (8 if cores in ("*", "") else max(int(cores), 1))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if the
    session names none (local runs and tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder would not survive the loss of an executor
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        configured = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
