"""Vector columns in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Neither null nor empty, and without null, NaN or infinite components."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def rows_of(column: pa.Array) -> list[np.ndarray]:
    """One double vector per row of a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values, dtype=np.float64)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
