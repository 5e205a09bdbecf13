"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every source is a queue of its documents in shuffled order.  The k-th copy of
a document finishes at virtual time (words queued in its source up to and
with it, earlier copies included) / (weight of the source).  The mixture is
the queue sorted by finish time and cut where the budget is spent: that is at
the virtual time ``cut`` with sum over sources of min(most, weight * cut) =
budget, ``most`` being the words a source can give.  A source that runs dry
stops there and the others share what it leaves, by weight.

The running totals of a source are taken in shuffle buckets (prefixes of the
document's hash, a few thousand rows at most), each with the offset of the
buckets before it, in two levels: no task sees a whole source, however large.
Only the table of sources (one row each) meets in one task.

Null and empty texts have size 0 and are never taken; a null source is a source
of its own, last in order; repeated rows queue one by one (rows that tie in
id, size and text are alike in the result too); an empty table gives an empty
result.  Columns of the input stay as they are, unless an output has the same
name, which replaces them; the names used inside start with ``_m_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.llm.common import WORD_PATTERN, without

WEIGHTS = (3, 1, 2)
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _bucket(digits: int) -> Column:
    return F.substring("_m_hash", 1, digits)


def _sources(totals: DataFrame, weights: tuple[int, ...], share: float, copies: int) -> DataFrame:
    """One row per source: weight, target and the cut of the queue."""
    named = Window.orderBy("_m_none", "_m_source")
    n = len(weights)
    table = F.array(*[F.lit(w) for w in weights])
    ranked = totals.withColumn(
        "_m_weight", F.element_at(table, ((F.row_number().over(named) - 1) % n + 1).cast("int"))
    ).withColumn("_m_most", F.lit(copies) * F.col("_m_total"))
    everything = Window.partitionBy()
    dry = Window.orderBy(F.col("_m_most") / F.col("_m_weight"), "_m_none", "_m_source")
    before = dry.rowsBetween(Window.unboundedPreceding, -1)
    onward = dry.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("_m_total").over(everything) - F.coalesce(F.sum("_m_most").over(before), F.lit(0))
    solved = ranked.withColumn("_m_place", F.row_number().over(dry)).withColumn(
        "_m_level", left / F.sum("_m_weight").over(onward)
    )
    holds = F.col("_m_level") <= F.col("_m_most") / F.col("_m_weight")
    cut = F.min(F.when(holds, F.struct("_m_place", "_m_level"))).over(everything)["_m_level"]
    return solved.withColumn("_m_cut", cut).select(
        "_m_none",
        "_m_source",
        F.col("_m_total").alias("_m_source_size"),
        "_m_weight",
        "_m_cut",
        F.least(F.col("_m_most").cast("double"), F.col("_m_weight") * F.col("_m_cut")).alias("_m_target"),
    )


def queue(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    copies: int = 2,
) -> DataFrame:
    """``docs`` with ``_m_*`` columns: size, source size, weight, target, words
    queued up to the end of the first copy, and the cut.

    Sources in code-point order get ``weights`` in turn; the mixture holds
    ``share`` times all words, no source more than ``copies`` times its own."""
    rows = docs.withColumns(
        {
            "_m_size": word_count(F.col(text)) if size is None else size,
            "_m_none": F.col(source).isNull(),
            "_m_source": F.coalesce(F.col(source).cast("string"), F.lit("")),
            "_m_hash": F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")),
        }
    )
    count = docs.count()
    digits = max(2, math.ceil(math.log(max(count, 1) / BUCKET_ROWS, 16)))
    coarse = digits // 2
    key = ["_m_none", "_m_source"]
    totals = materialize(
        rows.groupBy(*key, _bucket(digits).alias("_m_bucket")).agg(F.sum("_m_size").alias("_m_words"))
    )
    upper = totals.groupBy(*key, F.substring("_m_bucket", 1, coarse).alias("_m_upper")).agg(
        F.sum("_m_words").alias("_m_upper_words")
    )
    earlier = (Window.unboundedPreceding, -1)
    above = Window.partitionBy(*key).orderBy("_m_upper").rowsBetween(*earlier)
    within = Window.partitionBy(*key, "_m_upper").orderBy("_m_bucket").rowsBetween(*earlier)
    upper = upper.withColumn("_m_above", F.coalesce(F.sum("_m_upper_words").over(above), F.lit(0))).drop(
        "_m_upper_words"
    )
    sources = _sources(totals.groupBy(*key).agg(F.sum("_m_words").alias("_m_total")), weights, share, copies)
    offsets = (
        totals.withColumn("_m_upper", F.substring("_m_bucket", 1, coarse))
        .withColumn("_m_inside", F.coalesce(F.sum("_m_words").over(within), F.lit(0)))
        .join(upper, [*key, "_m_upper"])
        .join(sources, key)
        .withColumn("_m_offset", F.col("_m_above") + F.col("_m_inside"))
        .drop("_m_words", "_m_upper", "_m_above", "_m_inside")
    )
    line = (
        Window.partitionBy(*key, "_m_bucket")
        .orderBy("_m_hash", F.col(id_col), "_m_size", F.xxhash64(F.col(text)) if size is None else F.lit(0))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_m_bucket", _bucket(digits))
        .join(offsets, [*key, "_m_bucket"])
        .withColumn("_m_queued", F.col("_m_offset") + F.sum("_m_size").over(line))
    )


def _finish(copy: int | Column) -> Column:
    return (F.col("_m_queued") + F.lit(copy) * F.col("_m_source_size")) / F.col("_m_weight")


def shares(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", copies: int = 2, **options
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words of all
    its copies in the mixture).  The text is read once and shuffled never."""
    narrow = docs.select(
        F.col(id_col).alias("_id"), F.col(source).alias("_from"), word_count(F.col(text)).alias("_words")
    )
    narrow = materialize(narrow)
    queued = queue(narrow, "_id", "_words", "_from", size=F.col("_words"), copies=copies, **options)
    taken = sum((F.when(_finish(c) <= F.col("_m_cut"), F.col("_m_size")).otherwise(0) for c in range(copies)), F.lit(0))
    return queued.select(
        F.col("_id").alias(id_col),
        F.col("_m_size").alias("size"),
        F.col("_m_source_size").alias("source_size"),
        F.col("_m_target").alias("target"),
        taken.cast("long").alias("taken"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    copies: int = 2,
    finish: str = "virtual_finish",
    **options,
) -> DataFrame:
    """The mixture itself: rows of ``docs``, one for each copy taken, with its
    virtual finish time, range-sorted by it."""
    docs = without(docs, [finish])
    queued = queue(docs, id_col, text, source, copies=copies, **options)
    times = F.filter(F.array(*[_finish(c) for c in range(copies)]), lambda t: t <= F.col("_m_cut"))
    return (
        queued.where(F.col("_m_size") > 0)
        .select(*docs.columns, F.explode(times).alias(finish))
        .orderBy(finish, id_col)
    )

