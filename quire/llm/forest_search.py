"""Approximate nearest neighbours by a forest of random-projection trees.

A tree halves the vectors again and again: a node's direction is the difference
of two random vectors of the node, its cut the median of the projections on it.
The trees are fitted on a bounded sample (``SAMPLE`` rows, at most ``MAX_LEAVES``
leaves each, so the forest's size does not follow the table); then every vector is
placed in its leaf of each tree.  A query walks all trees with one priority queue:
the side of a cut it is not on waits with the sum of the squared distances to
the cuts passed over, the nearest waiting side of any tree comes next, and the
queue ends when the leaves taken hold the row budget.  The vectors of those
leaves are ranked by their exact distance, in double precision on the original
values.

The budget is measured, not guessed: the true neighbours of ``PROBES`` queries
are found by brute force (one pass over the table), the queue's order tells how
many rows it takes to reach each of them, and the budget is the number that
reaches the share ``TARGET``.  Data without structure so get a larger one.

Equal vectors are one point that keeps its ``k + 1`` smallest rows, which are the
only ones that can be among the nearest of any query: copies of any number cost
one search and one place.  Points and queries meet by (leaf, salt): a leaf with
more than ``SALT_ROWS`` points is split and its queries are sent to each part.

Vectors that are null, empty, zero, or hold null or non-finite components take no
part, as do null ids.  Where lengths differ, missing components are 0.  Repeated
rows (id and vector equal) are one row; rows that share only the id are rows of
their own, each a candidate and, where ``is_query`` holds, a query with a list of
its own.  Equal distances go by the smaller id.  An empty table gives no row;
other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.functions.ranking import consecutive_index
from quire.llm.common import bounded_batches, bounded_sample, ids_unique, shuffle_partitions, tidy
from quire.llm.vectors import rows_of, usable

TREES = 8
LEAF_ROWS = 128
SAMPLE = 16_384
MAX_LEAVES = 2_048
PROBES = 128
TARGET = 0.95
SALT_ROWS = 65_536
# queries that meet the rows of a leaf at a time
QUERY_BLOCK = 1_024
# pairs that a task holds before it hands them over
HELD_PAIRS = 2_000_000

RESULT = "query_id long, rank int, vec_id long, score double"


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Forest:
    """Complete binary trees of one depth: node i has the children 2i + 1 and
    2i + 2, leaves follow the inner nodes."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int, scale: float, seed: int = 11):
        self.depth, self.trees, self.scale = depth, trees, scale
        self.inner, self.leaves = (1 << depth) - 1, 1 << depth
        width = sample.shape[1]
        self.normals = np.zeros((trees, self.inner, width))
        self.cuts = np.zeros((trees, self.inner))
        x = sample / scale
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            rows = {0: np.arange(len(x))}
            for node in range(self.inner):
                mine = rows.pop(node)
                normal = np.zeros(width)
                if len(mine) > 1:
                    a, b = x[rng.choice(mine, 2, replace=False)]
                    normal = a - b
                if not normal.any():
                    normal = rng.standard_normal(width)
                normal /= np.linalg.norm(normal)
                place = x[mine] @ normal
                cut = np.median(place) if len(mine) else 0.0
                self.normals[t, node], self.cuts[t, node] = normal, cut
                rows[2 * node + 1], rows[2 * node + 2] = mine[place < cut], mine[place >= cut]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        x = x / self.scale
        out = np.zeros((len(x), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, self.normals[t][node]) >= self.cuts[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - self.inner
        return out

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Signed distance of each row to the cut of each node, (rows, trees, nodes)."""
        flat = self.normals.reshape(-1, self.normals.shape[2])
        found = (x / self.scale) @ flat.T - self.cuts.reshape(-1)
        return found.reshape(len(x), self.trees, self.inner)

    def walk(self, margins: np.ndarray, counts: list[list[int]], budget: int) -> list[tuple[int, int]]:
        """(tree, leaf) as one queue over all trees gives them, until the leaves
        taken hold ``budget`` rows."""
        sides = margins.tolist()
        queue = [(0.0, t, 0) for t in range(self.trees)]
        taken, rows = [], 0
        while queue and rows < budget:
            far, t, node = heapq.heappop(queue)
            side = sides[t]
            while node < self.inner:
                m = side[node]
                right = m >= 0
                heapq.heappush(queue, (far + m * m, t, 2 * node + (1 if right else 2)))
                node = 2 * node + (2 if right else 1)
            leaf = node - self.inner
            if counts[t][leaf]:
                taken.append((t, leaf))
                rows += counts[t][leaf]
        return taken

    def rows_before(self, margins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """(tree, leaf): rows of the leaves that the queue gives before this one."""
        far = np.zeros((self.trees, 1))
        for level in range(self.depth):
            m = margins[:, (1 << level) - 1 : (2 << level) - 1]
            both = np.stack([far + np.where(m >= 0, m * m, 0), far + np.where(m < 0, m * m, 0)], axis=2)
            far = both.reshape(self.trees, -1)
        order = np.argsort(far.reshape(-1), kind="stable")
        sizes = counts.reshape(-1)[order]
        before = np.empty(len(order), np.int64)
        before[order] = np.cumsum(sizes) - sizes
        return before.reshape(counts.shape)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a binary column of packed doubles."""
    if not len(column):
        return np.zeros((0, width))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], "<f8", len(column) * width, int(at[0])).reshape(-1, width)


def _packed(matrix: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(matrix, dtype="<f8")
    at = np.arange(len(flat) + 1, dtype=np.int32) * (flat.shape[1] * 8)
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(at), pa.py_buffer(flat)])


def _squares(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Squared distances by one product; rounded, so only good for choosing."""
    return (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None] - 2 * queries @ rows.T


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(1))


def _points(vectors: DataFrame, is_query: Column, k: int, id_col: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(pid, h, g, v, members) per distinct vector, and the query rows (key, id, h, g, v)."""
    zero = ~F.exists("v", lambda x: x != 0)
    rows = vectors.where(usable(vector) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.where(~zero)
    if ids_unique(rows, "id"):
        rows = rows.withColumn("key", F.col("id"))
    else:
        rows = rows.groupBy("id", "v").agg(F.max("asks").alias("asks"))
        rows = consecutive_index(rows, [F.col("id"), F.col("v")], "key")
    rows = rows.withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.lit(1), "v")})
    order = Window.partitionBy("h", "v").orderBy("key")
    kept = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    points = kept.groupBy("h", "v").agg(
        F.first("g").alias("g"), F.sort_array(F.collect_list(F.struct("key", "id"))).alias("members")
    )
    points = materialize(points.select(F.col("members")[0]["key"].alias("pid"), "h", "g", "v", "members"))
    return points, materialize(rows.where("asks").select("key", "id", "h", "g", "v"))


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    target: float = TARGET,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every row
    where ``is_query`` holds, among all other rows; score is the distance."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    points, rows = _points(vectors, is_query, k, id_col, vector)
    facts = points.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("v")).alias("width"),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("scale"),
    ).first()
    if not facts["n"]:
        return spark.createDataFrame([], RESULT)
    width = facts["width"]
    sample = bounded_sample(points, "pid", {"v": F.col("v")}, SAMPLE)
    wanted = min(facts["n"] / leaf_rows, MAX_LEAVES, len(sample) / 8)
    depth = max(0, int(np.floor(np.log2(max(wanted, 1)))))
    forest = Forest(padded([np.array(r["v"]) for r in sample], width), depth, trees, facts["scale"])
    shared = spark.sparkContext.broadcast(forest)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        total = np.zeros(f.trees * f.leaves, np.int64)
        for b in batches:
            cells = f.place(padded(rows_of(b.column(0)), width)) + np.arange(f.trees) * f.leaves
            total += np.bincount(cells.reshape(-1), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    sizes = points.select("v").mapInArrow(tidy(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(trees * forest.leaves, np.int64)
    for r in sizes.collect():  # one number for each leaf of the forest
        counts[r["cell"]] = r["n"]
    counts = counts.reshape(trees, forest.leaves)

    # the distinct query vectors, under the key of their point
    asked = rows.groupBy("h", "g").agg(F.first("v").alias("v"))
    asked = materialize(asked.join(points.select("pid", "h", "g"), ["h", "g"]).select("pid", "h", "g", "v"))
    budget = _budget(points, asked, forest, counts, k, width, target)
    salts = np.maximum(1, -(-counts // salt_rows)).astype(np.int64)
    plan = spark.sparkContext.broadcast((counts.tolist(), salts, budget))
    schema = "cell long, salt int, is_row boolean, pid long, v binary"
    names = ["cell", "salt", "is_row", "pid", "v"]

    def sent(cell, salt, is_row, pid, x) -> pa.RecordBatch:
        columns = [pa.array(cell, pa.int64()), pa.array(salt, pa.int32()), pa.array(np.full(len(pid), is_row))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(pid, pa.int64()), _packed(x)], names=names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, (_, salts, _) = shared.value, plan.value
        for b in batches:
            pid, x = np.asarray(b.column(0)), padded(rows_of(b.column(1)), width)
            leaf = f.place(x)
            for t in range(f.trees):
                yield sent(t * f.leaves + leaf[:, t], pid % salts[t][leaf[:, t]], True, pid, x)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, (counts, salts, budget) = shared.value, plan.value
        for b in batches:
            pid, x = np.asarray(b.column(0)), padded(rows_of(b.column(1)), width)
            for at in range(0, len(x), 16):
                margins = f.margins(x[at : at + 16])
                visits = [
                    (t * f.leaves + leaf, s, at + i)
                    for i, m in enumerate(margins)
                    for t, leaf in f.walk(m, counts, budget)
                    for s in range(salts[t][leaf])
                ]
                if visits:
                    cell, salt, who = np.array(visits).T
                    yield sent(cell, salt, False, pid[who], x[who])

    together = points.select("pid", "v").mapInArrow(tidy(place), schema)
    together = together.unionByName(asked.select("pid", "v").mapInArrow(tidy(ask), schema))
    together = together.repartition(shuffle_partitions(spark), "cell", "salt")
    together = together.sortWithinPartitions("cell", "salt", "is_row")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, queries = None, []
        # what the leaves of this task gave, brought down to k + 1 points a query
        pairs: list[tuple] = []
        held = 0
        for b in batches:
            cell, salt, is_row, pid = (np.asarray(b.column(i)) for i in range(4))
            x = _matrix(b.column(4), width)
            edge = (np.diff(cell) != 0) | (np.diff(salt) != 0) | (np.diff(is_row.astype(np.int8)) != 0)
            edge = np.concatenate([[0], np.flatnonzero(edge) + 1, [len(cell)]])
            for a, z in zip(edge[:-1], edge[1:]):
                if a == z:
                    continue
                if (cell[a], salt[a]) != here:
                    here, queries = (cell[a], salt[a]), []
                if not is_row[a]:
                    for at in range(a, z, QUERY_BLOCK):
                        part = slice(at, min(z, at + QUERY_BLOCK))
                        queries.append((pid[part].copy(), x[part].copy(), np.full((part.stop - part.start, k + 1), np.inf)))
                    continue
                for ids, vectors, best in queries:
                    found = _nearest(ids, vectors, best, pid[a:z], x[a:z])
                    if len(found[0]):
                        pairs.append(found)
                        held += len(found[0])
                if held > HELD_PAIRS:
                    pairs = [_least(pairs, k + 1)]
                    held = len(pairs[0][0])
                    if held > HELD_PAIRS // 2:  # few queries meet twice here: hand over
                        yield _pairs(pairs[0])
                        pairs, held = [], 0
        if pairs:
            yield _pairs(_least(pairs, k + 1))

    found = together.mapInArrow(tidy(rank), "qpid long, pid long, d double")
    by = Window.partitionBy("qpid").orderBy("d", "pid")
    # a point may come from every tree; copies are next to each other in this order
    found = found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= trees * (k + 1))
    found = found.dropDuplicates(["qpid", "pid"]).withColumn("place", F.row_number().over(by))
    found = found.where(F.col("place") <= k + 1).select("qpid", "pid", "d")
    listed = found.join(points.select("pid", F.explode("members").alias("m")), "pid")
    # at most k + 1 points of k + 1 rows
    listed = listed.groupBy("qpid").agg(F.sort_array(F.collect_list(F.struct("d", "m.key", "m.id"))).alias("found"))
    queries = rows.select("key", "id", "h", "g").join(asked.select(F.col("pid").alias("qpid"), "h", "g"), ["h", "g"])
    others = F.filter("found", lambda x: x["key"] != F.col("key"))
    out = queries.join(listed, "qpid").select("id", F.posexplode(F.slice(others, 1, k)).alias("at", "one"))
    return out.select(
        F.col("id").alias("query_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("one.id").alias("vec_id"),
        F.col("one.d").alias("score"),
    )


def _nearest(ids, queries, best, pid, x) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, exact distance) of those rows that may be among the nearest
    of this leaf; ``best`` holds each query's least distances here so far."""
    least = best[:, -1]
    squares = _squares(queries, x)
    slack = 1e-9 * ((queries**2).sum(1).max() + (x**2).sum(1).max())
    keep = best.shape[1]
    if x.shape[0] > keep:
        kth = np.partition(squares, keep - 1, axis=1)[:, keep - 1]
    else:
        kth = np.full(len(queries), np.inf)
    with np.errstate(invalid="ignore", over="ignore"):
        far = squares > np.minimum(kth, least**2)[:, None] + slack  # not so for NaN: overflow must not lose a row
    q, r = np.nonzero(~far)
    d = distances(queries[q], x[r])
    # the new least distances of each query
    order = np.lexsort((d, q))
    by, near = q[order], d[order]
    place = np.arange(len(by)) - np.searchsorted(by, by)
    some = place < keep
    fresh = np.full(best.shape, np.inf)
    fresh[by[some], place[some]] = near[some]
    best[:] = np.sort(np.concatenate([best, fresh], axis=1), axis=1)[:, :keep]
    return ids[q], pid[r], d


def _least(pairs: list[tuple], keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` nearest different points of each query."""
    q, pid, d = (np.concatenate(x) for x in zip(*pairs))
    order = np.lexsort((pid, d, q))
    q, pid, d = q[order], pid[order], d[order]
    new = np.ones(len(q), bool)  # a point has one distance to a query, so its copies are neighbours
    new[1:] = (q[1:] != q[:-1]) | (pid[1:] != pid[:-1])
    q, pid, d = q[new], pid[new], d[new]
    some = np.arange(len(q)) - np.searchsorted(q, q) < keep
    return q[some], pid[some], d[some]


def _pairs(found: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["qpid", "pid", "d"])


def _budget(
    points: DataFrame, asked: DataFrame, forest: Forest, counts: np.ndarray, k: int, width: int, target: float
) -> int:
    """Rows that the queue must take to reach ``target`` of the true ``k`` nearest
    points of a sample of the queries."""
    least = forest.trees * (k + 1)  # leaves with so many rows hold k + 1 points
    if forest.depth == 0:
        return least
    sample = bounded_sample(asked, "pid", {"v": F.col("v")}, PROBES)
    ids = np.array([r["_sampled"] for r in sample], np.int64)
    probes = padded([np.array(r["v"]) for r in sample], width)
    shared = points.sparkSession.sparkContext.broadcast((ids, probes))

    def truth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, probes = shared.value
        best = np.full((len(ids), k), np.inf)
        near = np.zeros((len(ids), k, width))
        for b in batches:
            x = padded(rows_of(b.column(1)), width)
            squares = _squares(probes, x)
            squares[ids[:, None] == np.asarray(b.column(0))[None]] = np.inf
            at = np.argsort(squares, axis=1)[:, :k]
            every = np.concatenate([best, np.take_along_axis(squares, at, 1)], axis=1)
            both = np.concatenate([near, x[at]], axis=1)
            first = np.argsort(every, axis=1)[:, :k]
            best, near = np.take_along_axis(every, first, 1), np.take_along_axis(both, first[:, :, None], 1)
        q, j = np.nonzero(np.isfinite(best))
        columns = [pa.array(q), pa.array(best[q, j]), _packed(near[q, j])]
        yield pa.RecordBatch.from_arrays(columns, names=["probe", "d", "v"])

    found = points.select("pid", "v").mapInArrow(tidy(truth), "probe long, d double, v binary")
    found = found.withColumn("place", F.row_number().over(Window.partitionBy("probe").orderBy("d", "v")))
    needs: list[int] = []
    leaves: dict[int, list[np.ndarray]] = {}
    for r in found.where(F.col("place") <= k).select("probe", "v").collect():  # PROBES x k rows
        leaves.setdefault(r["probe"], []).append(np.frombuffer(r["v"], "<f8"))
    for probe, vectors in leaves.items():
        before = forest.rows_before(forest.margins(probes[probe : probe + 1])[0], counts)
        where = forest.place(np.stack(vectors))
        needs += before[np.arange(forest.trees), where].min(1).tolist()
    if not needs:
        return least
    needs.sort()
    return max(least, needs[min(len(needs) - 1, int(np.ceil(target * len(needs))) - 1)] + 1)
