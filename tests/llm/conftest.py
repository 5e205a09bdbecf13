from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(brute.odd_documents(), brute.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


@pytest.fixture(scope="session")
def repeated(spark):
    """Null ids, repeated rows and rows that share only the id."""
    rows = [r for r in brute.odd_documents(2) if r[1] is None or len(r[1]) < 5000]
    rows += rows[9:12] + [(rows[10][0], "another text under this id", "en", "a", 1, 0.0, "x")]
    rows += [(None, rows[9][1], "en", None, 1, 0.0, "x"), (None, "null id", "en", "a", 1, 0.0, "x")]
    return spark.createDataFrame(rows, brute.SCHEMA)
