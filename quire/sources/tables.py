"""Parquet table access.

Every reader returns a lazy DataFrame; column pruning and filter pushdown
happen when the caller projects/filters (the plans show ``ReadSchema`` and
``PushedFilters`` on the scan).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(base_dir, name))
