"""Near-duplicate vectors by cross-polytope hashing.

Vectors are padded to a power of two, rotated by rounds of random signs and
fast Hadamard transforms, and hashed to the signed axis they are nearest to;
HASHES such axes make the code of one of TABLES tables.  A vector lies in the
bucket of its code and is also looked up in those of its PROBES next codes (the
ones for which the rotated vector gives up least).  Pairs of a resident with any
other member of a bucket are verified by their cosine in double precision, and
a verified pair counts in the first table where it meets only, so the number
of links needs no list of pairs: a task gives one row per vector with its
number of links and the smallest vector it is connected to.

Equal vectors are one class with a weight.  Vectors travel only to buckets
that hold a second member; a bucket larger than BLOCK rows is cut into blocks
and joined block by block, so no task holds a whole group of copies.

Pairs at a cosine of 0.9 in 64 dimensions meet with a probability over 0.99, closer
ones nearly always; no pair below the threshold links.  Null, empty and zero
vectors and vectors with null or non-finite components link with nothing.
Vectors of different lengths do not link.  Rows that repeat (id and vector) are
one vector and get the same result; rows that share only the id are told apart
by the vector, null ids come first.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.llm.common import bounded_batches, connected_components, local_roots, with_unique_key
from quire.llm.vectors import rows_of, usable

HASHES, TABLES, PROBES = 3, 10, 7
DEPTH = 4  # axes considered in each hash when probing
ROUNDS = 3
BLOCK = 2048
THRESHOLD = 0.9
MAX_DIMENSION = 8192


@lru_cache(maxsize=8)
def _signs(width: int) -> np.ndarray:
    draw = np.random.default_rng(width).integers(0, 2, (TABLES, HASHES, ROUNDS, width))
    return draw * 2.0 - 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two wide)."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, width)
        h *= 2
    return x


def codes(x: np.ndarray) -> np.ndarray:
    """(rows, TABLES, 1 + PROBES) codes, the vector's own first."""
    width = 1 << max(x.shape[1] - 1, 0).bit_length()
    depth = min(DEPTH, width)
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    steps = [c for c in itertools.product(range(depth), repeat=HASHES) if sum(c) <= DEPTH]
    out = np.empty((len(x), TABLES, 1 + PROBES), np.int64)
    for t in range(TABLES):
        axes, sizes = [], []
        for k in range(HASHES):
            y = padded
            for r in range(ROUNDS):
                y = hadamard(y * _signs(width)[t, k, r]) / np.sqrt(width)
            best = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :depth]
            value = np.take_along_axis(y, best, 1)
            axes.append(best * 2 + (value < 0))
            sizes.append(np.abs(value))
        loss = np.stack([sum((sizes[k][:, 0] - sizes[k][:, c[k]]) ** 2 for k in range(HASHES)) for c in steps], 1)
        code = np.stack([sum(axes[k][:, c[k]] * (2 * width) ** k for k in range(HASHES)) for c in steps], 1)
        pick = np.argsort(loss, axis=1, kind="stable")[:, : 1 + PROBES]
        found = np.take_along_axis(code, pick, 1)
        out[:, t, : found.shape[1]] = found
        out[:, t, found.shape[1] :] = -1
    return out


def slots(code: np.ndarray, dimension: int) -> np.ndarray:
    """Bucket number of each code: dimension, table and code in one long."""
    table = np.arange(TABLES)[None, :, None]
    return np.where(code < 0, -1, (dimension << 48) | (table << 42) | code)


def _counts_here(ci, cj, slot) -> np.ndarray:
    """Whether a bucket is the one in which the pairs of codes are counted."""
    bi, bj = ci[:, :, 0], cj[:, :, 0]
    same = bi == bj
    i_in_j = (ci[:, :, 1:] == bj[:, :, None]).any(2)
    j_in_i = (cj[:, :, 1:] == bi[:, :, None]).any(2)
    first = np.argmax(same | i_in_j | j_in_i, 1)
    rows = np.arange(len(ci))
    bi, bj = bi[rows, first], bj[rows, first]
    same, i_in_j, j_in_i = same[rows, first], i_in_j[rows, first], j_in_i[rows, first]
    home = np.where(same, bi, np.where(i_in_j & j_in_i, np.minimum(bi, bj), np.where(i_in_j, bj, bi)))
    return ((first.astype(np.int64) << 42) | home) == (slot & ((1 << 48) - 1))


def _group_pairs(group: np.ndarray, side: np.ndarray, x: np.ndarray, threshold: float):
    """Pairs of rows of equal ``group`` (sorted) on different sides, or both on
    side 2, whose inner product reaches the threshold."""
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    size = np.diff(edge)
    small = np.repeat(size <= 64, size)
    for k in range(1, int(size[size <= 64].max(initial=0))):
        i = np.flatnonzero(small[:-k] & (group[:-k] == group[k:]))
        for at in range(0, len(i), 100_000):
            a = i[at : at + 100_000]
            hit = np.einsum("ij,ij->i", x[a], x[a + k]) >= threshold
            yield a[hit], a[hit] + k
    for a, n in zip(edge[:-1][size > 64], size[size > 64]):
        for s in range(a, a + n, 512):
            e = min(s + 512, a + n)
            i, j = np.nonzero(x[s:e] @ x[s : a + n].T >= threshold)
            keep = i < j
            yield i[keep] + s, j[keep] + s


LINKED = "rep long, links long, head long"


def _verify(rows: DataFrame, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        columns = [np.asarray(t[c]) for c in ("slot", "p", "q", "rep", "weight", "mine")]
        order = np.lexsort((columns[3], *columns[:3][::-1]))
        slot, p, q, rep, weight, mine = (c[order] for c in columns)
        change = (slot[1:] != slot[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
        group = np.concatenate([[0], np.cumsum(change)])
        side = np.where(p == q, 2, (mine == q).astype(int))
        code = np.stack([np.frombuffer(t["codes"][int(r)].as_py(), "<i8") for r in order])
        code = code.reshape(len(order), TABLES, 1 + PROBES)
        home = ((np.arange(TABLES) << 42) | code[:, :, 0]) == (slot & ((1 << 48) - 1))[:, None]
        home = home.any(1)
        dims = slot >> 48
        links = np.zeros(len(order), np.int64)
        a, b = [], []
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = np.stack([np.frombuffer(t["unit"][int(r)].as_py(), "<f8") for r in order[at]])
            for i, j in _group_pairs(group[at], side[at], x, threshold):
                i, j = at[i], at[j]
                fits = (home[i] | home[j]) & ((side[i] != side[j]) | (side[i] == 2))
                i, j = i[fits], j[fits]
                once = _counts_here(code[i], code[j], slot[i])
                i, j = i[once], j[once]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                a.append(i)
                b.append(j)
        names, index = np.unique(rep, return_inverse=True)
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        roots = local_roots(len(names), index[a], index[b])
        total = np.bincount(index, links, len(names)).astype(np.int64)
        hit = total > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[hit]), pa.array(total[hit]), pa.array(names[roots[hit]])], names=["rep", "links", "head"]
        )

    return rows.mapInArrow(run, LINKED)


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    spark = df.sparkSession
    bounded_batches(spark)
    keyed = with_unique_key(
        df.select(F.col(id_col), F.col(vector).alias("_vector"), F.col(vector).cast("string").alias("_content")),
        id_col,
        "_content",
    )

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, digest, unit = [], [], []
            for k, v in zip(b.column(0).to_pylist(), rows_of(b.column(1))):
                length = np.sqrt(v @ v)
                if not 0 < length < np.inf:  # zero, or beyond the range of squares
                    top = np.abs(v).max()
                    if not top:
                        continue
                    v = v / top
                    length = np.sqrt(v @ v)
                if len(v) > MAX_DIMENSION:
                    raise ValueError(f"vectors of more than {MAX_DIMENSION} components")
                key.append(k)
                digest.append(hashlib.md5(v.tobytes()).digest())
                unit.append((v / length).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(digest, pa.binary()), pa.array(unit, pa.binary())],
                names=["key", "digest", "unit"],
            )

    good = keyed.where(usable("_vector")).select("_quire_key", F.col("_vector").cast("array<double>"))
    found = materialize(good.mapInArrow(units, "key long, digest binary, unit binary").dropDuplicates(["key"]))
    classes = found.groupBy("digest").agg(
        F.min("key").alias("rep"), F.count(F.lit(1)).alias("weight"), F.min("unit").alias("unit")
    )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = [np.frombuffer(x, "<f8") for x in b.column(3).to_pylist()]
            packed, dims = [None] * len(vectors), np.array([len(v) for v in vectors])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for i, c in zip(at, codes(np.stack([vectors[i] for i in at]))):
                    packed[i] = c.astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(dims.astype(np.int64)), pa.array(packed, pa.binary())],
                names=[*b.schema.names, "dimension", "codes"],
            )

    coded_schema = "digest binary, rep long, weight long, unit binary, dimension long, codes binary"
    reps = materialize(classes.mapInArrow(coded, coded_schema))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = np.stack([np.frombuffer(x, "<i8") for x in b.column(2).to_pylist()])
            code = code.reshape(-1, TABLES, 1 + PROBES)
            at = slots(code, 0) + (np.asarray(b.column(1))[:, None, None] << 48)
            rep = np.repeat(np.asarray(b.column(0)), TABLES * (1 + PROBES))
            own = np.zeros(code.shape, np.int64)
            own[:, :, 0] = 1
            real = (code >= 0).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.ravel()[real]), pa.array(rep[real]), pa.array(own.ravel()[real])],
                names=["slot", "rep", "own"],
            )

    placed = materialize(reps.select("rep", "dimension", "codes").mapInArrow(places, "slot long, rep long, own long"))
    buckets = (
        placed.groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("own"))
        .where("n > 1 and own > 0")
        .select("slot", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    )
    rows = (
        placed.drop("own")
        .join(buckets, "slot")
        .withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"p": F.least("mine", "with"), "q": F.greatest("mine", "with")})
        .join(reps.select("rep", "weight", "unit", "codes"), "rep")
        .select("slot", "p", "q", "mine", "rep", "weight", "unit", "codes")
        .repartition(F.col("slot"), F.col("p"), F.col("q"))
    )
    linked = materialize(_verify(rows, threshold))
    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(linked.where("rep <> head"), "rep", "head")
    by_rep = (
        reps.select("digest", "rep", "weight")
        .join(links, "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "digest",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("_links"),
            F.coalesce("component", "rep").alias("_component"),
        )
    )
    by_key = found.select(F.col("key").alias("_quire_key"), "digest").join(by_rep, "digest").drop("digest")
    out = (
        keyed.select(F.col(id_col), "_quire_key")
        .join(by_key, "_quire_key", "left")
        .withColumn("_component", F.coalesce("_component", "_quire_key"))
    )
    names = out.select(F.col("_quire_key").alias("_component"), F.col(id_col).alias("component_id")).distinct()
    return out.join(names, "_component").select(
        id_col,
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        (F.col("_quire_key") == F.col("_component")).alias("kept"),
    )
