"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.sources.tables import read_table

# the word definition of the contracts: runs of anything but ASCII white space
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# rows of one Arrow batch; texts are a few kB, so a batch stays at a few MB
BATCH_ROWS = 512


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="quire-package-"), "quire.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    packed.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)


def bounded_batches(spark: SparkSession) -> None:
    """Keep batches of texts small, those of the Parquet reader (its column
    arrays are large objects in the executor's heap) and those sent to Python
    workers, and make sure the workers can import the package."""
    ship_package(spark)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, giving freed memory back to the system when a task ends: workers
    live on, and executors count what they hold beside other stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return read_table(spark, sf_dir, name)


def bounded_sample(df: DataFrame, id_col: str, columns: dict[str, Column], rows: int) -> list:
    """``columns`` of the ``rows`` smallest hashes of the id, to the driver: ids
    are chosen first, so a task sends ids only, whatever the columns' size."""
    ids = df.select(F.col(id_col).alias("_sampled")).distinct()
    ids = ids.orderBy(F.xxhash64("_sampled"), "_sampled").limit(rows)
    found = df.join(F.broadcast(ids), F.col(id_col).eqNullSafe(F.col("_sampled")))
    found = found.select("_sampled", *[c.alias(n) for n, c in columns.items()])
    return found.dropDuplicates(["_sampled"]).orderBy("_sampled").collect()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one uint8 array, and the n + 1 offsets
    of its rows in it.  Null texts have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    off = off.astype(np.int64)
    size = int(off[-1] - off[0])
    raw = np.frombuffer(data, np.uint8, size, int(off[0])) if size else np.zeros(0, np.uint8)
    return raw, off - off[0]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (in place where possible)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def connected_components(
    edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60
) -> DataFrame:
    """(node, component) for every node of ``edges``, component = smallest
    node that can be reached.

    Each round gives every node the smallest label among itself and its
    neighbours (``min`` is combined on the map side, so a node of any degree
    costs one row per task), then replaces the label by its label's label.
    Rounds are written under the shared checkpoint folder; the loop ends when
    no label changes.  Only the count of changed labels reaches the driver.
    """
    both = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    both = materialize(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    for _ in range(max_rounds):
        heard = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        near = labels.join(heard, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label")
        )
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = materialize(
            near.join(up, "label", "left").select(
                "node", "old", F.least("label", F.coalesce("up", "label")).alias("label")
            )
        )
        changed = after.where("old <> label").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError("components did not settle; raise max_rounds")


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes over the pairs (a, b)."""
    root = np.arange(n)
    if len(a) == 0:
        return root
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = np.minimum(root, root[root])
        if np.array_equal(before, root):
            return root


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns that an output of this name replaces."""
    gone = {n.lower() for n in names}
    return df.select(*[c for c in df.columns if c.lower() not in gone])


class SpanHash:
    """64-bit hashes of byte spans of one array, from running sums.

    A span's hash is the sum of (code of the byte) * M^(place in the span)
    modulo 2^64, so any span costs one subtraction and one product."""

    _m = pow(0x9E3779B97F4A7C15, 3, 1 << 64) | 1
    _grown = 0
    _up = _down = None

    def __init__(self, raw: np.ndarray, codes: np.ndarray):
        self._powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(codes[raw] * SpanHash._up[: len(raw)], out=self.sums[1:])

    @classmethod
    def _powers(cls, n: int) -> None:
        if n > cls._grown:
            size = max(n, 1 << 19)
            with np.errstate(over="ignore"):
                for name, m in (("_up", cls._m), ("_down", pow(cls._m, -1, 1 << 64))):
                    powers = np.full(size, m, np.uint64)
                    powers[0] = 1
                    setattr(cls, name, np.multiply.accumulate(powers))
            cls._grown = size

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * SpanHash._down[start]

    def windows(self, n: int) -> np.ndarray:
        """Hash of the ``n`` bytes from every position that has so many."""
        return (self.sums[n:] - self.sums[: len(self.sums) - n]) * SpanHash._down[: len(self.sums) - n]


def byte_codes(seed: int, lower: bool = False) -> np.ndarray:
    """A random 64-bit code per byte; with ``lower``, A-Z share those of a-z."""
    codes = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def document_groups(offsets: np.ndarray, limit: int = 500_000):
    """Ranges (i, j) of consecutive documents with at most ``limit`` bytes, or one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def ids_unique(df: DataFrame, id_col: str) -> bool:
    """No id is null or occurs twice."""
    ids = df.select(F.col(id_col).cast("long").alias("id"))
    seen = ids.agg(
        F.count(F.lit(1)).alias("n"), F.count("id").alias("known"), F.count_distinct("id").alias("distinct")
    ).first()
    return seen["n"] == seen["known"] == seen["distinct"]


def with_unique_key(df: DataFrame, id_col: str, text: str, unique: bool | None = None) -> DataFrame:
    """``df`` with a long ``_quire_key`` in the order of ``id_col`` that names each
    distinct (id, text): the id itself where ids are unique and not null.
    Repeated rows share a key; rows that share only the id, and null ids (first
    in order), are told apart by the hash of the text.  ``unique``: what
    ``ids_unique`` gives, if it is known."""
    if ids_unique(df, id_col) if unique is None else unique:
        return df.withColumn("_quire_key", F.col(id_col).cast("long"))
    from quire.functions.ranking import consecutive_index

    digest = F.sha2(F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")), 256)
    rows = df.withColumn("_quire_digest", digest)
    names = rows.select(F.col(id_col).alias("_quire_id"), "_quire_digest").distinct()
    order = [F.col("_quire_id").asc_nulls_first(), F.col("_quire_digest")]
    names = consecutive_index(names, order, "_quire_key")
    return rows.join(
        names.withColumnRenamed("_quire_digest", "_quire_d"),
        rows[id_col].eqNullSafe(names["_quire_id"]) & (rows["_quire_digest"] == F.col("_quire_d")),
    ).drop("_quire_id", "_quire_d", "_quire_digest")
