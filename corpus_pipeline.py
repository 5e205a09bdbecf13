"""A training corpus from raw documents, in five stages.

1. quality   - importance resampling rejects documents unlike the good ones
2. near_dups - of each group of documents that links of word shingles connect, the first stays
3. passages  - byte strings that were in an earlier document (or earlier place) are cut
4. mixing    - sources are repeated or cut to their target weights
5. tokens    - byte-level BPE ids of each document of the mixture

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, and ``run`` writes each stage as Parquet under the shared
checkpoint folder and reads it back as the next one's ``docs``.  All but the last
return the columns of ``documents``.  Null and empty texts pass the first three
stages and are never taken by the mixture; repeated rows (same id and text) are
one document to stage 2, which keeps one of them; an empty table goes through.

No stage but the mixing is expressible in SQL, so the tests hold ``run`` against
a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.llm import byte_bpe, importance, jaccard_join, mixing, suffix_dedup
from quire.llm.common import table

ORACLE_SQL = None

# near-duplicates: words of a shingle, percent of the union that must be shared
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the importance of their n-grams for good text."""
    drawn = importance.resample(docs, table(spark, sf_dir, "labels"), "quality", keep=docs.columns, prefix="_quire_")
    return drawn.where("_quire_selected").select(docs.columns)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component."""
    return jaccard_join.first_of_groups(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT).select(docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what stands earlier; ``n_chars`` follows the text."""
    cut = suffix_dedup.remove_repeats(docs, as_text=True, prefix="_quire_").withColumnRenamed("_quire_kept", "text")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in its order, one row for each copy."""
    return mixing.mix(docs, finish="_quire_finish").select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path(byte_bpe.RANKS)
    return byte_bpe.encode(docs.select("doc_id", "source", "text"), path=path, decoded=True).select(
        "doc_id",
        "source",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("near_dups", near_dups),
    ("passages", passages),
    ("mixing", mixing_stage),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
