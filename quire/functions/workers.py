"""Python workers of a cluster: the package's modules for tasks that run its code."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="quire-core-"), "quire.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    packed.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
