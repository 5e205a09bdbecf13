"""Exact top-k inner-product search, a block of documents at a time.

Vectors are quantised to whole numbers and kept in a block forward index: rows
in the order of (nearest pivot, id), BLOCK rows to a block, each with the
largest and smallest value of every term (dimension).  The sum over terms of
(query value * that block value which gives most) bounds the score of every row
in a block.  A query takes the blocks of a partition by falling bound, scores
them through the forward index, and stops where the bound is below its k-th
score; an equal bound goes on, as a tie may have a smaller id.

Building the index already searches each query among the rows of its own
partition (its neighbourhood); the k-th score found there is the query's first
threshold everywhere else, so most blocks fall at once and a partition gives only
rows that can still be in the answer.  Queries come in rounds of bounded size
that are broadcast to all partitions.

Vectors that are null, empty, or hold null or non-finite components take no part,
as do null ids.  Of rows that share an id the smallest vector counts.  Where
lengths differ, missing components are 0.  Scores are exact: in doubles while
they hold them, in unbounded integers beyond; a score outside a long raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.llm.common import bounded_batches, bounded_sample, shuffle_partitions
from quire.llm.vectors import rows_of, usable

SCALE = 64
BLOCK = 256
PIVOTS = 256
ROUND_VALUES = 1 << 21  # query values of one round: 16 MB of doubles
FOUND = "query_id long, vec_id long, score long"


def quantise(v: np.ndarray) -> np.ndarray:
    return np.floor(v * SCALE)


class Blocks:
    """The forward index of one partition."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.blocks = [(ids, matrix) for ids, matrix in blocks if len(ids)]
        shape = (len(self.blocks), width)
        self.high = np.stack([m.max(0) for _, m in self.blocks]) if self.blocks else np.zeros(shape)
        self.low = np.stack([m.min(0) for _, m in self.blocks]) if self.blocks else np.zeros(shape)

    def search(self, ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int):
        """(query index, vec_id, score) of the best ``k`` rows of each query here
        whose scores reach ``least``; ties go to the smaller id."""
        size = max(np.abs(self.high).max(initial=0), np.abs(self.low).max(initial=0))
        top = np.abs(queries).max(initial=0) * size * queries.shape[1]
        kind = np.float64 if top < 2**53 else object
        q = queries.astype(kind)
        if kind is object:
            q = np.vectorize(int, otypes=[object])(queries)
        bound = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        if kind is object:
            bound = bound * (1 + 1e-9 * np.sign(bound)) + 1  # rounded sums must not cut off
        order = np.argsort(-bound, axis=1, kind="stable")
        best: list[list[tuple]] = [[] for _ in ids]
        kth = least.astype(object) if kind is object else least.copy()
        alive = np.arange(len(ids))
        for step in range(len(self.blocks)):
            block = order[alive, step]
            alive_now = bound[alive, block] >= kth[alive]
            alive, block = alive[alive_now], block[alive_now]
            if not len(alive):
                break
            by = np.argsort(block, kind="stable")
            edge = np.flatnonzero(np.diff(block[by], prepend=-1))
            for a, b in zip(edge, np.append(edge[1:], len(by))):
                who = alive[by[a:b]]
                rows, matrix = self.blocks[block[by[a]]]
                m = matrix if kind is np.float64 else np.vectorize(int, otypes=[object])(matrix)
                scores = q[who] @ m.T
                good = scores >= kth[who][:, None]
                good &= rows[None, :] != ids[who][:, None]
                for x in np.flatnonzero(good.any(1)):
                    hit = good[x]
                    kept = best[who[x]]
                    kept += zip((-scores[x][hit]).tolist(), rows[hit].tolist())
                    kept.sort()
                    del kept[k:]
                    if len(kept) == k:
                        kth[who[x]] = max(kth[who[x]], -kept[-1][0])
        return [(i, vec, int(-neg)) for i, found in enumerate(best) for neg, vec in found]


def _pack(matrix: np.ndarray) -> bytes:
    return matrix.astype("<f8").tobytes()


def _padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _found_batch(rows, ids) -> pa.RecordBatch:
    columns = list(zip(*((int(ids[i]), vec, score) for i, vec, score in rows))) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row where
    ``is_query`` holds, against all other rows."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = (
        vectors.where(usable(vector) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("query"))
    )
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.max(F.size("v")).alias("width")
    ).first()
    if facts["n"] != facts["ids"]:
        rows = rows.groupBy("id").agg(F.min("v").alias("v"), F.max("query").alias("query"))
    width = facts["width"] or 1
    sample = bounded_sample(rows, "id", {"v": F.col("v")}, PIVOTS)
    pivots = _padded([np.array(r["v"]) for r in sample], width)
    pivots = pivots / np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-300)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _padded(rows_of(b.column(1)), width)
            pivot = np.argmax(x @ pivots.T, 1)
            values = [_pack(quantise(v)) for v in x]
            yield pa.RecordBatch.from_arrays(
                [pa.array(pivot), b.column(0), b.column(2), pa.array(values, pa.binary())],
                names=["pivot", "id", "query", "q"],
            )

    placed = rows.mapInArrow(near, "pivot long, id long, query boolean, q binary").repartitionByRange(
        shuffle_partitions(spark), "pivot", "id"
    )
    indexed = "ids binary, rows binary, query_id long, q binary, least long"
    names = [x.strip().split(" ")[0] for x in indexed.split(",")]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        order = np.lexsort((np.asarray(t["id"]), np.asarray(t["pivot"])))
        ids = np.asarray(t["id"])[order]
        packed = t["q"].combine_chunks()
        x = np.frombuffer(packed.buffers()[2], "<f8", len(ids) * width, packed.offset * width * 8)
        x = x.reshape(-1, width)[order]
        blocks = [(ids[a : a + BLOCK], x[a : a + BLOCK]) for a in range(0, len(ids), BLOCK)]
        none = pa.nulls(len(blocks), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i.astype("<i8").tobytes() for i, _ in blocks], pa.binary()),
                pa.array([_pack(m) for _, m in blocks], pa.binary()),
                none,
                pa.nulls(len(blocks), pa.binary()),
                none,
            ],
            names=names,
        )
        ask = np.flatnonzero(np.asarray(t["query"])[order])
        here = Blocks(blocks, width)
        for at in range(0, len(ask), 1024):
            part = ask[at : at + 1024]
            found = here.search(ids[part], x[part], np.full(len(part), -np.inf), k)
            scores: dict[int, list[int]] = {}
            for i, _, s in found:
                scores.setdefault(i, []).append(s)
            least = [min(scores[i]) if len(scores.get(i, ())) == k else None for i in range(len(part))]
            gone = pa.nulls(len(part), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [gone, gone, pa.array(ids[part]), pa.array([_pack(v) for v in x[part]], pa.binary()), pa.array(least, pa.int64())],
                names=names,
            )

    built = materialize(placed.mapInArrow(index, indexed))
    forward = built.where("ids is not null").select("ids", "rows")
    queries = built.where("query_id is not null").select("query_id", "q", "least")
    rounds = max(1, -(-2 * queries.count() * width // ROUND_VALUES))
    results = []
    for r in range(rounds):
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(rounds)) == r).collect()
        if part:
            results.append(_round(forward, part, width, k))
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = results[0]
    for other in results[1:]:
        found = found.unionByName(other)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _round(forward: DataFrame, part: list, width: int, k: int) -> DataFrame:
    ids = np.array([r["query_id"] for r in part], np.int64)
    queries = np.stack([np.frombuffer(r["q"], "<f8") for r in part])
    least = np.array([-np.inf if r["least"] is None else float(r["least"]) for r in part])
    shared = forward.sparkSession.sparkContext.broadcast((ids, queries, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for b in batches:
            for i, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                blocks.append((np.frombuffer(i, "<i8"), np.frombuffer(m, "<f8").reshape(-1, width)))
        if not blocks:
            return
        here = Blocks(blocks, width)
        ids, queries, least = shared.value
        for at in range(0, len(ids), 4096):
            part = slice(at, at + 4096)
            yield _found_batch(here.search(ids[part], queries[part], least[part], k), ids[part])

    return forward.mapInArrow(run, FOUND)
