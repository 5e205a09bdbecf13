"""ALS by normal equations whose values anyone can compute again.

Explicit feedback, weighted regularisation: with the other side's factors x
fixed, the factor w of a key with ratings r solves

    (sum x x' + reg_param * n * I) w = sum r x

over its n ratings, the equations MLlib's ALS solves.  The start is not drawn
from a generator but from md5 of (seed, item key, component), so the model
depends on the ratings alone: not on blocks, partitions or their order (up to
the rounding of sums).

A half step is one join and one aggregation: the products are summed as
columns on the map side first, so a key with a third of all ratings costs one
row a task, and what is shuffled is rank * (rank + 3) / 2 + 1 numbers a key and
task that has ratings of it.  The ratings are laid out by the key of the step, once
for users and once for items, so that is about one task a key however many there are.  The systems are solved by numpy, a batch of keys at a time.  Factors
are written after every half step (short lineage); the other side's
are broadcast only when they are counted small, else joined by key, where
AQE splits a hot one.

Ratings with a null key or a null or NaN rating are left out; repeated (user,
item) rows count as so many ratings.  No ratings give no factors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.joins import row_count_at_most
from quire.functions.lineage import materialize
from quire.functions.workers import ship_package
from quire.operators.recall import ALS_MAX_ITER, ALS_RANK, ALS_REG_PARAM

# factors of the fixed side are broadcast up to so many rows (8 MB at rank 10)
MAX_BROADCAST_FACTORS = 100_000
# the columns of a half step's sums grow with the square of the rank
MAX_RANK = 32


def start_component(key: Column, component: int, seed: int) -> Column:
    """Uniform in [0, 1): the first 8 hex digits of md5('seed#key#component')."""
    text = F.concat_ws("#", F.lit(str(seed)), key.cast("string"), F.lit(str(component)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def start_factors(ratings: DataFrame, item: str, rank: int, seed: int) -> DataFrame:
    """(item, factor) before the first step."""
    parts = [start_component(F.col(item), j, seed) for j in range(rank)]
    return ratings.select(item).distinct().select(item, F.array(*parts).alias("factor"))


def half_step(
    ratings: DataFrame,
    fixed: DataFrame,
    key: str,
    other: str,
    rating: str,
    rank: int,
    reg_param: float,
    small: bool = False,
) -> DataFrame:
    """(key, factor): the factors of ``key`` for the given ones of ``other``, which
    are broadcast if ``small``."""
    rows = ratings.join(F.broadcast(fixed) if small else fixed, other)
    upper = ", ".join(f"sum(factor[{i}] * factor[{j}])" for i in range(rank) for j in range(i, rank))
    right = ", ".join(f"sum({rating} * factor[{i}])" for i in range(rank))
    packed = rows.groupBy(key).agg(F.expr("double(count(1)) AS n"), F.expr(f"array({upper}) AS a"), F.expr(f"array({right}) AS b"))
    at = np.triu_indices(rank)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            left = np.zeros((m, rank, rank))
            left[:, at[0], at[1]] = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(m, len(at[0]))
            left[:, at[1], at[0]] = left[:, at[0], at[1]]
            n = batch.column(1).to_numpy(zero_copy_only=False)
            left[:, np.arange(rank), np.arange(rank)] += reg_param * n[:, None]
            right = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(m, rank, 1)
            factors = np.linalg.solve(left, right).reshape(-1)
            edges = pa.array(np.arange(m + 1) * rank, pa.int32())
            found = pa.ListArray.from_arrays(edges, pa.array(factors))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=[key, "factor"])

    return packed.mapInArrow(solve, f"{key} {ratings.schema[key].dataType.simpleString()}, factor array<double>")


def fit(
    ratings: DataFrame,
    user: str = "user_id",
    item: str = "article_id",
    rating: str = "clicked",
    rank: int = ALS_RANK,
    max_iter: int = ALS_MAX_ITER,
    reg_param: float = ALS_REG_PARAM,
    seed: int = 42,
    max_broadcast: int = MAX_BROADCAST_FACTORS,
) -> tuple[DataFrame, DataFrame]:
    """((user, factor), (item, factor)) after ``max_iter`` rounds of a user and an
    item step."""
    if not 1 <= rank <= MAX_RANK or max_iter < 1 or reg_param <= 0:
        raise ValueError(f"rank is 1 to {MAX_RANK}, max_iter at least 1, reg_param above 0")
    ship_package(ratings.sparkSession)
    value = F.col(rating).cast("double")
    rows = ratings.select(user, item, value.alias("_r")).dropna()  # NaN counts as missing
    # one copy by either key: nearly all ratings of a key are summed by one task, a hot key's by several
    by_user = materialize(rows.hint("rebalance", F.col(user)))
    by_item = materialize(by_user.hint("rebalance", F.col(item)))
    items = materialize(start_factors(by_item, item, rank, seed))
    # the keys of a side stay the same, so each is counted once
    small = [row_count_at_most(side, max_broadcast) for side in (items, by_user.select(user).distinct())]
    for _ in range(max_iter):
        users = materialize(half_step(by_user, items, user, item, "_r", rank, reg_param, small[0]))
        items = materialize(half_step(by_item, users, item, user, "_r", rank, reg_param, small[1]))
    return users, items
