"""Quality by importance resampling.

Two generative models over hashed word n-grams: one of the target (texts
labelled good), one of the raw corpus.  The log of their ratio on a text is its
log importance weight; adding an independent Gumbel variable to it and taking
the k largest draws k texts without replacement in proportion to the weights.
The texts that are not drawn are rejected.

Tokens are runs of letters, digits and non-ASCII characters, or runs of other
marks, with upper case kept; n-grams are single tokens and neighbouring pairs,
and a pair of equal tokens is one n-gram, "a token repeats", whatever the token.
The raw model is counted over all texts; the target model over at most
``sample_rows`` labelled texts (smallest hashes of the id).  ``k`` is the
number of texts whose log weight reaches the level that separates the labelled
texts best, so the size of the draw follows the corpus.  The Gumbel variable is
a function of the id, so reruns agree.

Null and empty texts have no n-grams: log weight 0.  Repeated rows get equal
keys; all rows with the k-th key are kept.  Without labels of both kinds
nothing can be rejected and every row is kept.  Input columns stay, unless an
output (behind ``prefix``) has the same name, which replaces them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.lineage import materialize
from quire.llm.common import (
    SpanHash,
    bounded_batches,
    byte_codes,
    document_groups,
    mix64,
    string_buffer,
    tidy,
    without,
)
from quire.llm.toxicity import labelled_sample

BITS = 16
SAMPLE_ROWS = 20_000
SMOOTHING = 1.0
# a good text lost weighs as much as so many bad ones kept, share for share
CAUTION = 10
SEED = 11

_WHITE, _WORD, _MARK = 0, 1, 2


def _classes() -> np.ndarray:
    kind = np.full(256, _MARK, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = _WHITE
    kind[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = _WORD
    return kind


def ngram_buckets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text index, bucket) of every single token and every pair of neighbours."""
    codes, kinds = byte_codes(2), _classes()
    for i, j in document_groups(offsets):
        a, b = int(offsets[i]), int(offsets[j])
        part, kind = raw[a:b], kinds[raw[a:b]]
        if not len(part):
            continue
        change = np.ones(len(part), bool)
        change[1:] = kind[1:] != kind[:-1]
        bounds = offsets[i:j] - a
        change[bounds[bounds < len(part)]] = True
        start = np.flatnonzero(change)
        end = np.append(start[1:], len(part))
        keep = kind[start] != _WHITE
        start, end = start[keep], end[keep]
        owner = np.searchsorted(offsets, start + a, "right") - 1
        token = mix64(SpanHash(part, codes).spans(start, end))
        yield owner, (token >> np.uint64(64 - BITS)).astype(np.int64)
        pair = mix64(token[:-1] * np.uint64(3) + token[1:])
        pair[token[:-1] == token[1:]] = np.uint64(7) << np.uint64(57)
        inside = owner[:-1] == owner[1:]
        yield owner[:-1][inside], (pair[inside] >> np.uint64(64 - BITS)).astype(np.int64)


def ngram_counts(texts: DataFrame) -> np.ndarray:
    """Count of each bucket over the single column of ``texts``: a vector of
    2^BITS counts from each task, summed by bucket in Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for b in batches:
            for _, buckets in ngram_buckets(*string_buffer(b.column(0))):
                total += np.bincount(buckets, minlength=1 << BITS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    summed = texts.mapInArrow(tidy(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << BITS)
    for r in summed.collect():  # at most 2^BITS rows
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    def share(n):
        return (n + SMOOTHING) / (n.sum() + SMOOTHING * len(n))

    return np.log(share(target)) - np.log(share(raw))


def log_weights(raw: np.ndarray, offsets: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    total = np.zeros(len(offsets) - 1)
    for owner, buckets in ngram_buckets(raw, offsets):
        total += np.bincount(owner, ratio[buckets], minlength=len(total))
    return total


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float | None]:
    """(log ratio of each bucket, level that separates good from other labelled
    texts best; None without labels of both kinds)."""
    bounded_batches(docs.sparkSession)
    sample = materialize(labelled_sample(docs, labels, label, id_col, text, sample_rows))
    good = F.col("_label") > 0
    ratio = log_ratio(ngram_counts(sample.where(good).select("_text")), ngram_counts(docs.select(text)))
    seen = weigh(sample.select("_label", "_text"), ratio, "_text").select("_label", "log_weight").collect()
    weights = np.array([r["log_weight"] for r in seen])
    kind = np.array([r["_label"] > 0 for r in seen], bool)
    if not kind.any() or kind.all():
        return ratio, None
    # level with the smallest weighted sum of the two error shares, in the middle of its gap
    order = np.argsort(weights, kind="stable")
    w, k = weights[order], kind[order]
    lost = np.concatenate([[0], np.cumsum(k)]) / k.sum()
    kept = 1 - np.concatenate([[0], np.cumsum(~k)]) / (~k).sum()
    cut = np.concatenate([[True], w[1:] > w[:-1], [True]])
    at = int(np.argmin(np.where(cut, CAUTION * lost + kept, np.inf)))
    edge = np.concatenate([[w[0] - 1], w, [w[-1] + 1]])
    return ratio, float((edge[at] + edge[at + 1]) / 2)


def weigh(docs: DataFrame, ratio: np.ndarray, text: str = "text", name: str = "log_weight") -> DataFrame:
    """``docs`` with the log weight of each text."""
    bounded_batches(docs.sparkSession)
    if text.lower() != name.lower():
        docs = without(docs, [name])
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = log_weights(*string_buffer(b.column(at)), ratio)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found)], names=[*b.schema.names, name])

    return docs.mapInArrow(tidy(run), schema)


def gumbel(id_col: str, seed: int = SEED):
    """A standard Gumbel variable from the hash of the id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def kth_largest(df: DataFrame, key: str, k: int, bins: int = 1024) -> float | None:
    """The ``k``-th largest value of a column: counts in ``bins`` equal bins of
    the range that holds it, narrowed until one value is left.  Nothing is sorted;
    a round returns ``bins`` counts."""
    if k <= 0:
        return None
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return None
    while low < high:
        width = (high - low) / bins
        if width <= 0 or low + width == low or high - width == high:
            break
        place = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        rows = (
            df.where((F.col(key) >= low) & (F.col(key) <= high))
            .groupBy(place.alias("place"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
            .collect()
        )
        for r in sorted(rows, key=lambda r: -r["place"]):
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
        else:
            return low
    return high


def resample(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    k: int | None = None,
    keep: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``log_weight``, ``draw`` (weight
    plus Gumbel variable) and ``selected``: whether the draw is among the ``k``
    largest."""
    ratio, level = fit(docs, labels, label, id_col, text, sample_rows)
    names = [prefix + n for n in ("log_weight", "draw", "selected")]
    weight, draw, selected = names
    narrow = docs.select(F.col(id_col), F.col(text).alias("_quire_text"))
    weighed = materialize(
        weigh(narrow, ratio, "_quire_text", weight).drop("_quire_text").withColumn(draw, F.col(weight) + gumbel(id_col))
    )
    if k is None and level is not None:
        k = weighed.where(F.col(weight) >= level).count()
    least = None if k is None else kth_largest(weighed, draw, k)
    if k is not None and least is None:
        least = float("inf")
    chosen = F.lit(True) if least is None else F.col(draw) >= F.lit(least)
    if keep is None or set(keep) <= {id_col}:
        return weighed.withColumn(selected, chosen)
    rows = without(docs.select(*dict.fromkeys([*keep, id_col, text])), names)
    return (
        weigh(rows, ratio, text, weight)
        .withColumn(draw, F.col(weight) + gumbel(id_col))
        .withColumn(selected, chosen)
    )
