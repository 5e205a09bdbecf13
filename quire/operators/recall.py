"""User recall with ALS.

* ``user_item_clicks``: behaviour newer than the date limit, the quote
  character stripped from the article id *before* grouping (the reference
  stripped after grouping and so could keep two rows for one pair), then
  max(click) per (user, article).
* ``index_keys``: the id maps -- frequency desc, ties by key asc, 0-based --
  the order MLlib's StringIndexer uses, computed distributed instead of
  collecting the label list to the driver.
* ``als_recall``: explicit-feedback ALS (rating = clicked), top-N items per
  user (already-clicked items are not excluded unless asked), ids mapped
  back, per-user list in rank order with duplicates removed.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.ranking import consecutive_index
from quire.functions.windows import behaviour_date_limit

# Fixed values of the reference's recall job (ALS settings are MLlib
# defaults apart from the checkpoint interval).
TOP_N = 50
ALS_RANK = 10
ALS_MAX_ITER = 10
ALS_REG_PARAM = 0.1
ALS_CHECKPOINT_INTERVAL = 1
# MLlib's default; part of the model's definition (blocks seed their factors)
ALS_BLOCKS = 10
# ALS takes int ids
MAX_ALS_ID = 2**31 - 1


def user_item_clicks(behaviour: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    """(user_id, article_id, clicked int)"""
    limit = behaviour_date_limit(as_of, days)
    return (
        behaviour.where(F.col("dt") > limit)
        .select(
            "user_id",
            F.translate(F.col("articles"), '"', "").alias("article_id"),
            "click_art",
        )
        .groupBy("user_id", "article_id")
        .agg(F.max("click_art").cast("int").alias("clicked"))
    )


def index_keys(clicks: DataFrame, key: str, index_col: str) -> DataFrame:
    """(key, index_col int): rank by (rows desc, key asc) - 1.  MLlib's ALS
    takes int ids; more keys than that raise."""
    counts = clicks.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    ranked = consecutive_index(counts, [F.col("_n").desc(), F.col(key).asc()], "_i")
    small = F.when(F.col("_i") <= MAX_ALS_ID, F.col("_i").cast("int")).otherwise(
        F.raise_error(F.lit(f"ALS holds at most {MAX_ALS_ID + 1} distinct {key} values"))
    )
    return ranked.select(key, small.cast("int").alias(index_col))


def indexed_ratings(clicks: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    return clicks.join(users, "user_id").join(items, "article_id").select(
        "als_user_id", "als_article_id", F.col("clicked").cast("float").alias("clicked")
    )


def fit_als(
    ratings: DataFrame,
    rank: int = ALS_RANK,
    max_iter: int = ALS_MAX_ITER,
    reg_param: float = ALS_REG_PARAM,
    seed: int = 42,
    blocks: int = ALS_BLOCKS,
) -> ALSModel:
    als = ALS(
        userCol="als_user_id",
        itemCol="als_article_id",
        ratingCol="clicked",
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        checkpointInterval=ALS_CHECKPOINT_INTERVAL,
        seed=seed,
    )
    als = als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return als.fit(ratings)


def recommendations(
    model: ALSModel,
    users: DataFrame,
    items: DataFrame,
    n: int = TOP_N,
    seen: DataFrame | None = None,
) -> DataFrame:
    """(user_id, rec_rank, article_id, rating): top-n per user, ids mapped
    back; unknown ids drop out.  With ``seen`` (user_id, article_id) the
    already-clicked items are removed."""
    return map_back(model.recommendForAllUsers(n), users, items, seen)


def map_back(
    recommended: DataFrame, users: DataFrame, items: DataFrame, seen: DataFrame | None = None
) -> DataFrame:
    """(als_user_id, recommendations array<struct<als_article_id, rating>>)
    -> (user_id, rec_rank, article_id, rating); ids missing from a map drop
    out (the reference's left joins followed by dropna)."""
    recs = recommended.select(
        "als_user_id", F.posexplode("recommendations").alias("_p", "_r")
    )
    recs = recs.select(
        "als_user_id",
        (F.col("_p") + 1).alias("rec_rank"),
        F.col("_r.als_article_id").alias("als_article_id"),
        F.col("_r.rating").alias("rating"),
    )
    out = (
        recs.join(users, "als_user_id", "left")
        .join(items, "als_article_id", "left")
        .select("user_id", "rec_rank", "article_id", "rating")
        .dropna()
    )
    if seen is not None:
        out = out.join(seen.select("user_id", "article_id"), ["user_id", "article_id"], "left_anti")
    return out


def id_list_text(ids: Column) -> Column:
    """The stored text form of an id list: ["a", "b"] (double quotes, ', '
    between items), as the reference's recall store holds it."""
    quoted = F.transform(ids, lambda x: F.concat(F.lit('"'), x, F.lit('"')))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def recall_lists(recs: DataFrame) -> DataFrame:
    """(user_id, n_items, als_ids text): the user's articles in rank order
    without repeats; users with an empty list are skipped."""
    grouped = recs.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("rec_rank", "article_id"))).alias("_l")
    )
    ids = F.array_distinct(F.col("_l.article_id"))
    return grouped.select("user_id", ids.alias("article_list")).where(F.size("article_list") > 0).select(
        "user_id", F.size("article_list").alias("n_items"), id_list_text(F.col("article_list")).alias("als_ids")
    )
