"""Exact top-n inner products of user and item factors, with pruning.

Items are sorted by the length of their factor and cut into blocks of
``BLOCK_ITEMS``.  A product is at most the product of the two lengths, so a
user's scan may stop at the first block whose longest item cannot reach the
user's n-th score any more:

1. every user is scored against block 0 (the longest items), which gives each
   an n-th score to beat;
2. ``needed_blocks`` turns that score into the number of blocks the user still
   needs, looked up in a ladder of block lengths (two rungs to a doubling of
   the number of blocks, so its size is the logarithm of the table's);
3. users meet exactly those blocks, and the best n of both steps are ranked.

A task of step 1 or 3 holds one block and at most about ``CHUNK_USERS`` users:
users are dealt into chunks by hash, and (block, chunk) is the key both sides
are grouped by, so neither a popular block nor many users fall on one task.
Nothing but the ladder and n item ids reaches the driver.

Ids are unique on both sides, as they are in factor tables.  A null id, a null
vector and a vector that holds null, NaN or an infinity take no part; vectors
of different lengths raise.  Equal scores rank by ascending item id.  Without
users or items the result is empty; users have fewer than n rows where there
are fewer items.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import vectors as vec
from quire.functions.lineage import materialize
from quire.functions.ranking import consecutive_index, top_k_per_group
from quire.functions.workers import ship_package

BLOCK_ITEMS = 1024
CHUNK_USERS = 4096
# rows of a chunk scored at a time: 512 x 1,024 scores are 4 MB
SCORED_ROWS = 512
# a bound computed in doubles may fall short of the product by rounding
SLACK = 1.0 + 1e-9


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(key).alias("_id"), v.alias("_v")).where(F.col("_id").isNotNull() & finite & (F.size("_v") > 0))
    return rows.withColumn("_length", F.sqrt(vec.dot(F.col("_v"), F.col("_v"))))


def item_blocks(items: DataFrame, key: str, vector: str, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(_block, _top, _ids, _flat): blocks of items by falling length; ``_top`` is
    the greatest length of the block."""
    order = [F.col("_length").desc(), F.col("_id").asc()]
    ranked = consecutive_index(_usable(items, key, vector), order, "_at")
    # at most block_items rows a group
    rows = ranked.groupBy(F.floor(F.col("_at") / F.lit(block_items)).alias("_block")).agg(
        F.max("_length").alias("_top"), F.sort_array(F.collect_list(F.struct("_at", "_id", "_v"))).alias("_rows")
    )
    return rows.select("_block", "_top", F.col("_rows._id").alias("_ids"), F.flatten("_rows._v").alias("_flat"))


def ladder_steps(blocks: int) -> list[int]:
    """Numbers of blocks a scan may be rounded up to: 1, 2, 3, 4, 6, 8, 12, ..."""
    steps, s = [], 1
    while s < blocks:
        steps.append(s)
        if s > 1 and s + s // 2 < blocks:
            steps.append(s + s // 2)
        s *= 2
    return [*steps, blocks]


def needed_blocks(length: Column, score: Column, ladder: list[tuple[int, float]]) -> Column:
    """How many blocks a user of this length scans to be sure of beating or
    equalling ``score`` (null: all).  ``ladder``: (number of blocks, greatest
    length of the items after them), falling."""
    stop = F.lit(ladder[-1][0])
    for blocks, following in reversed(ladder[:-1]):
        stop = F.when(length * F.lit(following) * F.lit(SLACK) < score, F.lit(blocks)).otherwise(stop)
    return stop


def _score(needs: DataFrame, dealt: DataFrame, n: int, user_type: str, item_type: str) -> DataFrame:
    """(_user, _item, _score): the best n of each user in each block needed;
    ``dealt`` holds a copy of a block (_to) for each chunk (_part) that needs it."""

    def best(users: pa.Table, block: pa.Table) -> pa.Table:
        out = {"_user": [], "_item": [], "_score": []}
        if users.num_rows and block.num_rows:
            ids = block.column("_ids").combine_chunks().flatten()
            right = block.column("_flat").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            by_id = pc.sort_indices(ids)  # of equal scores the first is the smaller id
            right = right.reshape(len(ids), -1)[by_id.to_numpy()].T.copy()
            ids = ids.take(by_id)
            left = users.column("_v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            if left.size != users.num_rows * len(right):
                raise ValueError(f"factors of different lengths: {left.size // users.num_rows} and {len(right)}")
            left = left.reshape(users.num_rows, -1)
            top = block.column("_top")[0].as_py()
            floor = users.column("_floor").to_numpy()
            length = users.column("_length").to_numpy()
            # the ladder rounds up: users whose bound ends before this block
            live = np.flatnonzero(~(length * top * SLACK < floor))
            for at in range(0, len(live), SCORED_ROWS):
                rows = live[at : at + SCORED_ROWS]
                # the same order of additions whatever rows are scored together
                scores = np.zeros((len(rows), len(ids)))
                for j in range(len(right)):
                    scores += left[rows, j : j + 1] * right[j]
                limit = floor[rows]
                if len(ids) > n:
                    limit = np.fmax(limit, np.partition(scores, len(ids) - n, axis=1)[:, len(ids) - n])
                kept = scores >= limit[:, None]
                for tied in np.flatnonzero(kept.sum(axis=1) > n):
                    kept[tied] = False
                    kept[tied, np.argsort(-scores[tied], kind="stable")[:n]] = True
                r, c = np.nonzero(kept)
                out["_user"].append(users.column("_id").take(pa.array(rows[r])).combine_chunks())
                out["_item"].append(ids.take(pa.array(c)))
                out["_score"].append(pa.array(scores[r, c]))
        types = (users.schema.field("_id").type, block.schema.field("_ids").type.value_type, pa.float64())
        columns = [pa.chunked_array(out[name], kind) for name, kind in zip(out, types)]
        return pa.table(columns, names=list(out))

    return (
        needs.groupBy("_block", "_chunk")
        .cogroup(dealt.groupBy("_to", "_part"))
        .applyInArrow(best, f"_user {user_type}, _item {item_type}, _score double")
    )


def top_products(
    users: DataFrame,
    items: DataFrame,
    n: int,
    user: str = "user_id",
    item: str = "article_id",
    vector: str = "factor",
    block_items: int = BLOCK_ITEMS,
    chunk_users: int = CHUNK_USERS,
) -> DataFrame:
    """(user, rank int from 1, item, score): each user's n items of the greatest
    inner product, exactly; ``vector`` names the factor column of both sides."""
    if n < 1:
        raise ValueError("n counts from 1")
    spark = users.sparkSession
    ship_package(spark)
    types = users.schema[user].dataType.simpleString(), items.schema[item].dataType.simpleString()
    blocks = materialize(item_blocks(items, item, vector, max(block_items, n)))
    everyone = _usable(users, user, vector)
    ready = everyone.where("_length > 0")
    chunks = max(1, -(-ready.count() // chunk_users))
    ready = materialize(ready.withColumn("_chunk", F.pmod(F.xxhash64("_id"), F.lit(chunks)).cast("int")))
    nothing = F.lit(float("-inf"))

    first = ready.select("*", nothing.alias("_floor"), F.lit(0).cast("long").alias("_block"))
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    longest = blocks.where("_block = 0").withColumnRenamed("_block", "_to").withColumn("_part", every_chunk)
    head = materialize(_score(first, longest, n, *types))
    total = blocks.count()
    found = head.unionByName(_smallest_ids(everyone, items, item, vector, n))
    if total > 1:
        ladder = block_ladder(blocks, total)
        # the n-th score of block 0, which holds at least n items here
        tops = top_k_per_group(head, "_user", [F.col("_score").desc(), F.col("_item").asc()], n, "_rank")
        floors = tops.groupBy(F.col("_user").alias("_id")).agg(F.min("_score").alias("_floor"))
        later = ready.join(floors, "_id").withColumn("_need", needed_blocks(F.col("_length"), F.col("_floor"), ladder))
        later = later.where("_need > 1").withColumn("_block", F.explode(F.sequence(F.lit(1), F.col("_need") - 1)))
        later = later.withColumn("_block", F.col("_block").cast("long")).drop("_need")
        later = materialize(later)
        wanted = later.select(F.col("_block").alias("_to"), F.col("_chunk").alias("_part")).distinct()
        dealt = wanted.join(blocks, F.col("_to") == F.col("_block")).drop("_block")
        found = found.unionByName(_score(later, dealt, n, *types))
    ranked = top_k_per_group(found, "_user", [F.col("_score").desc(), F.col("_item").asc()], n, "rank")
    return ranked.select(
        F.col("_user").alias(user), "rank", F.col("_item").alias(item), F.col("_score").alias("score")
    )


def _smallest_ids(everyone: DataFrame, items: DataFrame, item: str, vector: str, n: int) -> DataFrame:
    """(_user, _item, _score) of the users of length 0; n ids come to the driver."""
    ids = _usable(items, item, vector).select("_id").orderBy("_id").limit(n).collect()
    smallest = F.array(*[F.lit(r["_id"]) for r in ids]).cast(f"array<{items.schema[item].dataType.simpleString()}>")
    idle = everyone.where("_length = 0")
    return idle.select(F.col("_id").alias("_user"), F.explode(smallest).alias("_item"), F.lit(0.0).alias("_score"))


def block_ladder(blocks: DataFrame, total: int) -> list[tuple[int, float]]:
    """(number of blocks, greatest length of the items after them), two rungs to a
    doubling: at most 2 log2(blocks) + 2 rows come to the driver."""
    steps = ladder_steps(total)
    tops = {r["_block"]: r["_top"] for r in blocks.where(F.col("_block").isin(steps)).select("_block", "_top").collect()}
    return [(s, tops.get(s, 0.0)) for s in steps]
