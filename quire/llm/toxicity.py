"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed byte n-grams of the lower-cased text, present or not.
Each is scaled by its log-count ratio between toxic and other texts, a
logistic regression is fitted on the scaled features, and a text's score is
its probability.  The fit uses at most ``sample_rows`` labelled rows (those
with the smallest hash of the id) and the ``features`` n-grams whose counts
differ most for their size; scoring reads every text whole.

Null and empty texts have no features and get the score of the intercept.
Rows with a null or conflicting label: null labels are left out, of several
the largest counts.  With labels of one class only (or none) the score is the
smoothed share of toxic rows.  Repeated rows are scored alike; of the
input only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.llm.common import SpanHash, bounded_batches, byte_codes, mix64, string_buffer, tidy

ORDERS = (3, 4, 5)
BITS = 20
CHUNK = 1 << 18
SAMPLE_ROWS = 20_000
FEATURES = 4096
PENALTY = 1e-3


def text_buckets(raw: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...] = ORDERS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text index, bucket) of every n-gram, in chunks of positions; n-grams
    stay inside their text."""
    codes = byte_codes(1, lower=True)
    for a in range(0, len(raw), CHUNK):
        b = min(a + CHUNK + max(orders) - 1, len(raw))
        hashes = SpanHash(raw[a:b], codes)
        owner = np.searchsorted(offsets, np.arange(a, min(a + CHUNK, len(raw))), "right") - 1
        room = offsets[owner + 1] - np.arange(a, a + len(owner))
        for n in orders:
            grams = hashes.windows(n)[: len(owner)]
            inside = room[: len(grams)] >= n
            buckets = mix64(grams[inside] + np.uint64(n)) >> np.uint64(64 - BITS)
            yield owner[: len(grams)][inside], buckets.astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Weight of each chosen bucket (scaling included) and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float
    orders: tuple[int, ...] = ORDERS

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        k, n = len(self.buckets), len(offsets) - 1
        place = np.full(1 << BITS, -1, np.int32)
        place[self.buckets] = np.arange(k)
        total = np.full(n, self.intercept)
        pairs = present(raw, offsets, place, k, self.orders)
        np.add.at(total, pairs // max(k, 1), self.weights[pairs % max(k, 1)])
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def present(
    raw: np.ndarray, offsets: np.ndarray, place: np.ndarray, k: int, orders: tuple[int, ...] = ORDERS
) -> np.ndarray:
    """Sorted distinct (text index * k + feature) of the chosen features."""
    found = [np.zeros(0, np.int64)]
    for owner, buckets in text_buckets(raw, offsets, orders):
        feature = place[buckets]
        hit = feature >= 0
        found.append(np.unique(owner[hit] * k + feature[hit]))
    return np.unique(np.concatenate(found))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str, text: str, rows: int
) -> DataFrame:
    """(_id, _label, _text) of at most ``rows`` labelled documents; the ids are
    broadcast (8 bytes each, so ``rows`` bounds them) and the texts stay spread."""
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where("_id is not null and _label is not null")
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    return texts.join(F.broadcast(chosen), "_id").select("_id", "_label", "_text")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    penalty: float = PENALTY,
    orders: tuple[int, ...] = ORDERS,
) -> Model:
    """Fit on the labelled rows given (leave held-out rows out of ``labels``)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
    from pyspark.ml.linalg import Vectors

    spark = docs.sparkSession
    bounded_batches(spark)
    sample = materialize(labelled_sample(docs, labels, label, id_col, text, sample_rows))
    sizes = {int(r["_label"] > 0): r["n"] for r in sample.groupBy((F.col("_label") > 0).cast("int").alias("_label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    none = Model(np.zeros(0, np.int64), np.zeros(0), math.log((pos + 1) / (neg + 1)), orders)
    if not pos or not neg:
        return none

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for b in batches:
            toxic = np.array(b.column(1).to_pylist()) > 0
            raw, offsets = string_buffer(b.column(2))
            pairs = present(raw, offsets, np.arange(1 << BITS, dtype=np.int64), 1 << BITS, orders)
            of = toxic[pairs >> BITS]
            for c in (0, 1):
                counts[c] += np.bincount(pairs[of == bool(c)] & ((1 << BITS) - 1), minlength=1 << BITS)
        used = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[1, used]), pa.array(counts[0, used])], names=["bucket", "p", "q"])

    # documents with each n-gram by class; ratio of the smoothed shares, and how
    # far the difference is beyond what the counts explain
    p, q = (F.col("p") + 1) / (pos + 2), (F.col("q") + 1) / (neg + 2)
    both = (F.col("p") + F.col("q") + 1) / (pos + neg + 2)
    surprise = F.abs(p - q) / F.sqrt(both * (1 - both * 0.999) * (1 / pos + 1 / neg))
    chosen = (
        sample.mapInArrow(tidy(count), "bucket long, p long, q long")
        .groupBy("bucket")
        .agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
        .select("bucket", F.log(p / q).alias("ratio"), surprise.alias("surprise"))
        .orderBy(F.desc("surprise"), "bucket")
        .limit(features)
        .collect()
    )
    if not chosen:
        return none
    buckets = np.array([r["bucket"] for r in chosen], np.int64)
    ratios = np.array([r["ratio"] for r in chosen])
    place = np.full(1 << BITS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = string_buffer(b.column(2))
            pairs = present(raw, offsets, place, len(buckets), orders)
            cuts = np.searchsorted(pairs, np.arange(b.num_rows + 1) * len(buckets)).astype(np.int32)
            words = pa.array((pairs % len(buckets)).astype(str), pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((np.array(b.column(1).to_pylist()) > 0).astype(float)),
                    pa.ListArray.from_arrays(pa.array(cuts), words),
                ],
                names=["label", "grams"],
            )

    grams = materialize(sample.mapInArrow(vectors, "label double, grams array<string>"))
    vectorizer = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(len(buckets))], inputCol="grams", outputCol="seen", binary=True
    )
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="seen", outputCol="features")
    regression = LogisticRegression(regParam=penalty, standardization=False, maxIter=60)
    fitted = regression.fit(scaled.transform(vectorizer.transform(grams)).select("label", "features"))
    return Model(buckets, fitted.coefficients.toArray() * ratios, float(fitted.intercept), orders)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score) of every row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col), F.col(text).alias("_text"))
    schema = rows.drop("_text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = model.scores(*string_buffer(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], names=[id_col, "score"])

    return rows.mapInArrow(tidy(run), schema)
