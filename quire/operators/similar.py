"""Similar articles: pairs (new article, recent article) closer than a
Euclidean threshold.

``similar_exact`` is an exact distance join without a cross join.  Each
vector is projected on ``projections`` fixed random unit directions (seeded,
passed as literal arrays; their length is read from one new row);
projections never increase distances, so two vectors closer than ``t`` have
every projection within ``t`` and their grid cells (width ``t``) differ by at
most one per direction.  The new side is replicated to its 3**k neighbour
cells and equi-joined with the history side on the cell key, then the true
distance is checked.  When the new side is proven small it is broadcast and
the history side is streamed without any shuffle.  Otherwise both sides are
shuffled on the cell key, without the rows of cells that only one of them has.
A cell is cut into blocks of at most about ``hot_cell_rows`` rows (``BLOCK_ROWS`` at
most) by a hash of the id on both sides; each pair of blocks is one group, small
cells share one.  A task thus holds two blocks, compares them by products of
matrices of ``SCORED_PAIRS`` pairs and checks the true distance of what is left, so
a cell that holds the whole table (``t`` near the data's spread) costs the
arithmetic of its pairs and no shuffle of candidates.

``similar_lsh`` is the approximate join for production, the same hash family
as the reference's (bucketed random projections) in DataFrame functions; its
pairs are a subset of the exact ones.  ``similar_mllib_lsh`` is MLlib's own.

All drop self pairs and pairs at distance 0 (exact copies are not
"similar"), and keep the distance rounded to 4 decimals.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import vectors as vec
from quire.functions.joins import row_count_at_most
from quire.functions.lineage import materialize
from quire.functions.workers import ship_package

# Fixed values of the reference's similarity stage.
LSH_SEED = 125
LSH_BUCKET_LENGTH = 1.0
LSH_HASH_TABLES = 1
DISTANCE_THRESHOLD = 380.0
DISTANCE_DECIMALS = 4

# LSH join for a given threshold (ours): a pair at the threshold t has projections
# that differ by about t / sqrt(components); it shares a bucket of twice that in
# 61 % of the tables, so all six miss it in 0.4 % of the cases
JOB_BUCKET_SPREADS = 2.0
JOB_HASH_TABLES = 6

# exact join defaults (ours)
GRID_PROJECTIONS = 2
GRID_SEED = 7
# a grid cell holding more rows than this is split into salts of at most about
# this many rows
HOT_CELL_ROWS = 1_000_000
# ... and no block of either side holds more (8,192 vectors of 64 components: 4 MB)
BLOCK_ROWS = 8_192
# pairs of a block compared at a time (doubles), candidates checked at a time
SCORED_PAIRS = 4_000_000
CHECKED_PAIRS = 65_536
# relative rounding error allowed for in a square distance by products
SQUARE_SLACK = 1e-9
# the new side is broadcast only while (rows x 3**projections) stays under
# this bound; each replica carries one vector
MAX_BROADCAST_REPLICAS = 20_000


def _directions(dim: int, k: int, seed: int) -> list[list[float]]:
    """k fixed random unit vectors of length ``dim`` (Gaussian, normalised)."""
    rnd = np.random.RandomState(seed)
    d = rnd.standard_normal((k, dim))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    return d.tolist()


def _cells(vcol, threshold: float, directions: list[list[float]]):
    dim = len(directions[0])
    checked = F.when(F.size(vcol) == dim, vcol).otherwise(
        F.raise_error(F.lit(f"similarity join needs vectors of length {dim}"))
    )
    return [
        F.floor(vec.dot(checked, F.array(*[F.lit(x) for x in u])) / F.lit(threshold)).alias(f"_c{i}")
        for i, u in enumerate(directions)
    ]


def _keep_pair(a_id, b_id, dist):
    return (a_id != b_id) & (dist != 0)


def similar_exact(
    new: DataFrame,
    history: DataFrame,
    threshold: float = DISTANCE_THRESHOLD,
    projections: int = GRID_PROJECTIONS,
    hot_cell_rows: int = HOT_CELL_ROWS,
    max_broadcast_replicas: int = MAX_BROADCAST_REPLICAS,
    seed: int = GRID_SEED,
) -> DataFrame:
    """(article_id, similar_id, distance) for new x history with
    distance < threshold.  Inputs: (article_id, articlevector)."""
    k = projections
    first = new.select(F.size("articlevector").alias("n")).first()
    if first is None:  # no new article: no pair
        return new.sparkSession.createDataFrame([], "article_id long, similar_id long, distance double")
    directions = _directions(first.n, k, seed)
    cells = [f"_c{i}" for i in range(k)]

    h = history.select(
        F.col("article_id").alias("similar_id"),
        F.col("articlevector").alias("_hv"),
        *_cells(F.col("articlevector"), threshold, directions),
    )
    offsets = F.array(
        *[
            F.struct(*[F.lit(o).alias(f"_o{i}") for i, o in enumerate(combo)])
            for combo in itertools.product((-1, 0, 1), repeat=k)
        ]
    )
    n = new.select(
        "article_id",
        F.col("articlevector").alias("_nv"),
        *_cells(F.col("articlevector"), threshold, directions),
    ).withColumn("_off", F.explode(offsets))
    # one copy per neighbour cell
    n = n.select(
        "article_id", "_nv", *[(F.col(f"_c{i}") + F.col(f"_off._o{i}")).alias(f"_c{i}") for i in range(k)]
    )

    if row_count_at_most(new, max_broadcast_replicas // 3**k):
        # small new side: broadcast it, stream the history without a shuffle
        dist = vec.euclidean(F.col("_nv"), F.col("_hv"))
        pairs = h.join(F.broadcast(n), cells).select("article_id", "similar_id", dist.alias("_d"))
        pairs = pairs.where(
            (F.col("_d") < F.lit(threshold)) & _keep_pair(F.col("article_id"), F.col("similar_id"), F.col("_d"))
        )
    else:
        none = [F.lit(0).alias("_t"), F.array().cast("array<bigint>").alias("_bs")]
        pairs = _close_pairs(
            n.select("*", *none), h.select("*", *none), cells, threshold, min(hot_cell_rows, BLOCK_ROWS)
        )
    return pairs.select(
        "article_id",
        "similar_id",
        (F.round("_d", DISTANCE_DECIMALS) + F.lit(0.0)).alias("distance"),
    )


def _close_pairs(new: DataFrame, history: DataFrame, cell: list[str], threshold: float, block_rows: int) -> DataFrame:
    """(article_id, similar_id, _d): the pairs of a cell that are closer than ``threshold``.

    ``new`` (article_id, _nv) and ``history`` (similar_id, _hv) come with the columns of
    ``cell``, ``_t`` and ``_bs``: a pair whose ``_bs`` agree at a place before ``_t`` is left
    to the cell of that place, so a pair that meets in several tables is given once.
    Only rows of cells that both sides have are shuffled."""
    spark = new.sparkSession
    ship_package(spark)
    new = new.where(F.col("article_id").isNotNull()).dropna(subset=cell)
    history = history.where(F.col("similar_id").isNotNull()).dropna(subset=cell)
    rows = lambda df, name: df.groupBy(*cell).agg(F.count(F.lit(1)).alias(name))
    salts = lambda name: F.ceil(F.col(name) / F.lit(block_rows)).cast("int")
    # one row for each cell that both sides have, numbered
    sizes = rows(new, "_n").join(rows(history, "_h"), cell)
    sizes = sizes.select(*cell, (F.col("_n") + F.col("_h")).alias("_rows"), salts("_n").alias("_ns"), salts("_h").alias("_hs"))
    sizes = materialize(sizes.withColumn("_cell", F.monotonically_increasing_id()))
    alone = (F.col("_ns") == 1) & (F.col("_hs") == 1)
    small = sizes.where(alone).agg(F.sum("_rows")).first()[0] or 0
    packs = max(1, -(-small // (2 * block_rows)))
    # small cells share a task by hash, the blocks of a larger one have one each
    pack = F.when(alone, -1 - F.pmod(F.xxhash64("_cell"), F.lit(packs))).otherwise(F.col("_cell")).alias("_pack")

    def dealt(df: DataFrame, side: int, key: str, vector: str, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias(own)
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        kept = [F.lit(side).alias("_side"), F.col(key).alias("_id"), F.col(vector).alias("_v"), "_t", "_bs"]
        out = df.join(sizes, cell).select(pack, "_cell", mine, copies, *kept)
        return out.select("_pack", "_ns", "_hs", "_cell", "_side", "_id", "_v", "_t", "_bs")

    both = dealt(new, 0, "article_id", "_nv", "_ns", "_hs").unionByName(
        dealt(history, 1, "similar_id", "_hv", "_hs", "_ns")
    )
    kind = both.schema["_id"].dataType.simpleString()
    # few bytes, much arithmetic: not packed into fewer tasks by AQE
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(tasks, "_pack", "_ns", "_hs")
    return both.groupBy("_pack", "_ns", "_hs").applyInArrow(
        _compare(threshold), f"article_id {kind}, similar_id {kind}, _d double"
    )


def _compare(threshold: float):
    """A task's pairs: the squared distance by a product of matrices, in blocks, leaves
    the candidates; their distance is summed component by component."""

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        column = pa.concat_arrays(column.chunks)
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        side, cell = table.column("_side").to_numpy(), table.column("_cell").to_numpy()
        places = []
        for s in (0, 1):
            mine = np.flatnonzero(side == s)
            places.append(mine[np.argsort(cell[mine], kind="stable")])
        if not (len(places[0]) and len(places[1])):
            return
        (x, y), (xb, yb) = ([matrix(table.column(c).take(pa.array(p))) for p in places] for c in ("_v", "_bs"))
        ids = table.column("_id").combine_chunks()
        xid, yid = (ids.take(pa.array(p)) for p in places)
        xn, yn = xid.to_numpy(zero_copy_only=False), yid.to_numpy(zero_copy_only=False)
        at = table.column("_t").to_numpy()[places[0]]
        with np.errstate(all="ignore"):
            xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
            # no distance from a vector with NaN or an infinity is below the threshold
            live = [np.isfinite(m).all(axis=1) for m in (x, y)]
            for c in np.intersect1d(cell[places[0]], cell[places[1]]):
                a, b = (np.flatnonzero((cell[p] == c) & ok) for p, ok in zip(places, live))
                right, t = y[b], at[np.searchsorted(cell[places[0]], c)]
                step = max(1, SCORED_PAIRS // max(1, len(b)))
                for k in range(0, len(a), step):
                    i = a[k : k + step]
                    rough = x[i] @ right.T
                    rough *= -2.0
                    # the expanded square may be off by rounding; one that overflows stays
                    rough += (xx[i] * (1.0 - SQUARE_SLACK))[:, None]
                    rough += (yy[b] * (1.0 - SQUARE_SLACK))[None, :]
                    r, q = np.nonzero(~(rough > threshold * threshold * (1.0 + SQUARE_SLACK)))
                    for m in range(0, len(r), CHECKED_PAIRS):
                        left, other = i[r[m : m + CHECKED_PAIRS]], b[q[m : m + CHECKED_PAIRS]]
                        steps = x[left].T - y[other].T
                        total = np.zeros(len(left))
                        for d in steps:  # in the order of the components
                            total += d * d
                        total = np.sqrt(total)
                        keep = (total < threshold) & (total != 0) & (xn[left] != yn[other])
                        if t:
                            keep &= ~(xb[left, :t] == yb[other, :t]).any(axis=1)
                        if keep.any():
                            found = [xid.take(pa.array(left[keep])), yid.take(pa.array(other[keep])), pa.array(total[keep])]
                            yield pa.RecordBatch.from_arrays(found, names=["article_id", "similar_id", "_d"])

    return run


def lsh_directions(dim: int, tables: int, seed: int = LSH_SEED) -> list[list[float]]:
    """The unit direction of each table, as short literals (the SQL statement of
    the query uses the same)."""
    return [[round(x, 6) for x in u] for u in _directions(dim, tables, seed)]


def similar_lsh(
    new: DataFrame,
    history: DataFrame,
    threshold: float,
    bucket_length: float | None = LSH_BUCKET_LENGTH,
    num_hash_tables: int = LSH_HASH_TABLES,
    seed: int = LSH_SEED,
    hot_bucket_rows: int = HOT_CELL_ROWS,
    staggered: bool = False,
) -> DataFrame:
    """Bucketed random projections: vectors whose projections on a table's
    direction fall into the same bucket of ``bucket_length`` are candidates.

    Vectors meet in the blocks of a bucket; a pair that shares several buckets is
    given by the first of their tables, so no list of candidates is written or made
    distinct.  A bucket is cut into blocks of ``hot_bucket_rows`` rows, ``BLOCK_ROWS``
    at most, on both sides.  The bucket length
    should match the spread of the vectors: wide buckets make all pairs
    candidates, narrow ones lose pairs.  None derives it from the threshold.
    ``staggered`` tables have their edges apart: else each has one at 0, and
    vectors on opposite sides of the origin never meet."""
    first = new.select(F.size("articlevector").alias("n")).first()
    if first is None:  # no new article: no pair
        return new.sparkSession.createDataFrame([], "article_id long, similar_id long, distance double")
    if bucket_length is None:
        bucket_length = JOB_BUCKET_SPREADS * threshold / math.sqrt(max(first.n, 1))
    directions = lsh_directions(first.n, num_hash_tables, seed)
    places = [
        vec.dot(F.col("articlevector"), F.array(*[F.lit(x) for x in u])) / F.lit(bucket_length) for u in directions
    ]
    if staggered:
        places = [p + F.lit(t / num_hash_tables) for t, p in enumerate(places)]
    buckets = F.array(*[F.floor(p) for p in places])
    key = ["_t", "_b"]
    bucketed = lambda df, own, v: df.select(
        F.col("article_id").alias(own), F.col("articlevector").alias(v), buckets.alias("_bs")
    ).select("*", F.posexplode("_bs").alias(*key))
    n, h = bucketed(new, "article_id", "_nv"), bucketed(history, "similar_id", "_hv")
    pairs = _close_pairs(n, h, key, threshold, min(hot_bucket_rows, BLOCK_ROWS))
    return pairs.select("article_id", "similar_id", (F.round("_d", DISTANCE_DECIMALS) + F.lit(0.0)).alias("distance"))


def similar_mllib_lsh(
    new: DataFrame,
    history: DataFrame,
    threshold: float = DISTANCE_THRESHOLD,
    bucket_length: float = LSH_BUCKET_LENGTH,
    num_hash_tables: int = LSH_HASH_TABLES,
    seed: int = LSH_SEED,
) -> DataFrame:
    """The reference's operator, MLlib's approxSimilarityJoin: it shuffles both
    vectors with every candidate pair, so it is kept for comparison only."""
    to_vec = lambda df: df.select(
        "article_id", array_to_vector("articlevector").alias("articlevector")
    )
    hist = to_vec(history)
    lsh = BucketedRandomProjectionLSH(
        inputCol="articlevector",
        outputCol="hashes",
        seed=seed,
        bucketLength=bucket_length,
        numHashTables=num_hash_tables,
    )
    model = lsh.fit(hist)
    joined = model.approxSimilarityJoin(to_vec(new), hist, threshold, distCol="dist")
    a, b, d = F.col("datasetA.article_id"), F.col("datasetB.article_id"), F.col("dist")
    return joined.where(_keep_pair(a, b, d)).select(
        a.alias("article_id"),
        b.alias("similar_id"),
        (F.round(d, DISTANCE_DECIMALS) + F.lit(0.0)).alias("distance"),
    )
