"""The registered queries: each applies one operator, with production
parameters, to its whole table and derives the contract's columns from the
operator's outputs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (
    byte_bpe,
    embedding_dedup,
    forest_search,
    importance,
    jaccard_join,
    mask_search,
    mixing,
    oracle,
    phrases,
    suffix_dedup,
    token_counts,
    topk_search,
    toxicity,
    warc,
)
from quire.llm.common import table

TOKEN_LIMIT = 4096


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; the model is
    fitted on rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.fit(docs, labels, "toxic")
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), ["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 20 best rows for every id divisible by 20."""
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path(byte_bpe.RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode(docs, path=path, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, log_weight, draw, selected for every document."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return importance.resample(docs, labels, "quality", keep=["doc_id"])


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back: the records' digest columns."""
    path = warc.write_archives(table(spark, sf_dir, "pages"))
    page = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) as bigint)")
    return warc.read_archives(spark, path, with_payload=False).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    found = jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    return mixing.shares(table(spark, sf_dir, "documents"))


def op11_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 10 nearest rows found for every id divisible by 100."""
    return forest_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op12_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the 10 best documents of every benchmark item."""
    return mask_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), 10)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first 2000 phrases of each language."""
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_topk_search": op3_topk_search,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_importance": op7_importance,
    "op8_warc": op8_warc,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_mixing": op10_mixing,
    "op11_forest_search": op11_forest_search,
    "op12_mask_search": op12_mask_search,
    "op13_phrases": op13_phrases,
}
# DuckDB statements for the queries that SQL can express
ORACLE: dict[str, str] = {
    "op3_topk_search": oracle.TOPK_SEARCH,
    "op5_embedding_dedup": oracle.EMBEDDING_DEDUP,
    "op8_warc": oracle.WARC,
    "op9_jaccard_join": oracle.JACCARD_JOIN,
    "op10_mixing": oracle.MIXING,
    "op12_mask_search": oracle.MASK_SEARCH,
    "op13_phrases": oracle.PHRASES,
}
