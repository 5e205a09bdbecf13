"""Ranked lexical search by presence masks.

Pass 1 reads every document once: the terms it shares with the items, with their
counts, and its length go into a forward index; document frequencies, the number
of documents and of terms are summed over all of them.  Pass 2 takes the index a
block of documents at a time.  For an item, the bit of each of its terms is
set (bitwise or, along the term's postings) in a mask of every document that holds
the term; equal masks make a group.  The sum over a mask's terms of weight times
the block's largest term score bounds every document of the group.  Groups are
scored by falling bound, in batches that double, until the bound is below the
item's k-th score; an equal bound goes on, as a tie may have a smaller id.  The
k-th score stays with the item from block to block.

Scores are whole numbers, exact in 64 bits.  Terms are known by 64-bit hashes.
Items are sent to the tasks in groups of at most ``GROUP_TERMS`` terms, one
run of both passes for each group; a benchmark has one.  Documents are never
shuffled, tasks hold a block of them, and what they emit is ``k`` rows an item.

Null and empty texts have no term: such a document counts nowhere, such an item
has no row.  Rows that share an ``item_id`` (null is one, too) are one item whose
terms are those of its distinct texts.  Repeated documents (id and text
equal) are one document; rows that share only the id are documents of their own
and may both be listed.  Equal scores go by id, null first.  Items longer than 64
terms have masks of several words.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.llm.common import (
    SpanHash,
    batch,
    bounded_batches,
    byte_codes,
    document_groups,
    ids_unique,
    mix64,
    string_buffer,
    tidy,
    with_unique_key,
)
from quire.llm.words import byte_class, word_spans

# letters and digits of ASCII, and every byte of any other character
TERM_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
GROUP_TERMS = 1 << 16
BLOCK_DOCUMENTS = 16_384
BLOCK_POSTINGS = 2_000_000
FIRST_GROUPS = 32

# fixed values of the score
WEIGHT_SCALE, TERM_SCALE, LENGTH_SHARE = 1000, 1_000_000_000, 75

RESULT = "item_id long, rank int, doc_id long, score long"


def _hashed(raw: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, its row)."""
    start, end, row = word_spans(raw, offsets, TERM_BYTES)
    return mix64(SpanHash(raw, codes).spans(start, end)).view(np.int64), row


def _terms(column: pa.Array, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per group of texts: first row, past-the-end row, term hashes, their rows from 0."""
    raw, offsets = string_buffer(column)
    for i, j in document_groups(offsets):
        here = raw[offsets[i] : offsets[j]]
        yield i, j, *_hashed(here, offsets[i : j + 1] - offsets[i], codes)


def item_terms(items: DataFrame, item_col: str, text: str) -> DataFrame:
    """(item_id, term, n) of the items' distinct texts."""
    codes = byte_codes(3, lower=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, _, term, row in _terms(b.column(1), codes):
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row + i)), pa.array(term)], names=["item_id", "term"])

    texts = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text).alias("text")).distinct()
    terms = texts.mapInArrow(run, "item_id long, term long")
    return terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n"))


class Item:
    """One item's terms: places in the vocabulary, weights, and the best so far."""

    def __init__(self, item_id: int | None, terms: np.ndarray, weights: np.ndarray, k: int):
        self.item_id, self.terms, self.weights, self.k = item_id, terms, weights, k
        self.scores = np.zeros(0, np.int64)
        self.keys = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)

    def least(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, keys: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        good = scores >= self.least()
        if not good.any():
            return
        scores = np.concatenate([self.scores, scores[good]])
        keys = np.concatenate([self.keys, keys[good]])
        ids = np.concatenate([self.ids, ids[good]])
        known = np.concatenate([self.known, known[good]])
        first = np.lexsort((keys, -scores))[: self.k]
        self.scores, self.keys, self.ids, self.known = scores[first], keys[first], ids[first], known[first]


class Block:
    """Postings of a block of documents, term by term, each with its score."""

    def __init__(self, keys, ids, known, lengths, doc, term, tf, size: int, n_docs: int, n_terms: int):
        self.keys, self.ids, self.known = keys, ids, known
        norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths.astype(np.int64) * n_docs) // n_terms
        order = np.argsort(term, kind="stable")
        self.doc, tf = doc[order], tf[order].astype(np.int64)
        self.impact = (TERM_SCALE * tf) // (1000 * tf + 8 * norm[self.doc])
        self.edge = np.searchsorted(term[order], np.arange(size + 1))
        self.best = np.zeros(size, np.int64)
        some = np.flatnonzero(np.diff(self.edge))
        if len(some):
            self.best[some] = np.maximum.reduceat(self.impact, self.edge[some])

    def masks(self, item: Item) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents, group of each, bits of each group): documents by the mask of
        the item's terms they hold."""
        words = -(-len(item.terms) // 64)
        mask = np.zeros((words, len(self.keys)), np.uint64)
        for j, t in enumerate(item.terms):
            mask[j // 64][self.doc[self.edge[t] : self.edge[t + 1]]] |= np.uint64(1) << np.uint64(j % 64)
        docs = np.flatnonzero(mask.any(0))
        found = np.ascontiguousarray(mask[:, docs].T)
        if words == 1:
            found, group = np.unique(found[:, 0], return_inverse=True)
            found = found[:, None]
        else:
            rows, group = np.unique(found.view(f"V{8 * words}")[:, 0], return_inverse=True)
            found = rows.view(np.uint64).reshape(-1, words)
        j = np.arange(len(item.terms))
        bits = (found[:, j // 64] >> (j % 64).astype(np.uint64)) & np.uint64(1)
        return docs, group.reshape(-1), bits.astype(bool)

    def score(self, item: Item, docs: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs`` (rising)."""
        total = np.zeros(len(docs), np.int64)
        for t, w in zip(item.terms, item.weights):
            a, z = self.edge[t], self.edge[t + 1]
            here = self.doc[a:z]
            at = np.searchsorted(here, docs)
            at[at == len(here)] = 0
            hit = here[at] == docs if len(here) else np.zeros(len(docs), bool)
            total[hit] += w * self.impact[a:z][at[hit]]
        return total

    def search(self, item: Item) -> None:
        docs, group, bits = self.masks(item)
        if not len(docs):
            return
        bound = bits @ (item.weights * self.best[item.terms])
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by = np.argsort(place[group], kind="stable")
        docs, edge = docs[by], np.searchsorted(place[group][by], np.arange(len(order) + 1))
        at, step = 0, FIRST_GROUPS
        while at < len(order):
            # groups whose bound still reaches the k-th score
            end = min(at + step, int(np.searchsorted(-bound, -item.least(), "right")))
            if end <= at:
                return
            some = np.sort(docs[edge[at] : edge[end]])
            item.add(self.score(item, some), self.keys[some], self.ids[some], self.known[some])
            at, step = end, 2 * step


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = 10,
    item_col: str = "item_id",
    item_text: str = "text",
    id_col: str = "doc_id",
    text: str = "text",
    group_terms: int = GROUP_TERMS,
    block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above
    0 for every item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if ids_unique(docs, "doc_id"):
        rows = docs.withColumn("_quire_key", F.col("doc_id"))
    else:
        rows = with_unique_key(docs, "doc_id", "text", False).dropDuplicates(["_quire_key"])
    rows = rows.select("_quire_key", "doc_id", "text")
    terms = materialize(item_terms(items, item_col, item_text))
    size = terms.count()
    if not size:
        return spark.createDataFrame([], RESULT)
    groups = -(-size // group_terms)
    part = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    found = None
    for g in range(groups):
        one = _search_group(rows, terms.where(part == g), k, block_documents)
        found = one if found is None else found.unionByName(one)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "key")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def _search_group(rows: DataFrame, terms: DataFrame, k: int, block_documents: int) -> DataFrame:
    spark = rows.sparkSession
    asked = terms.collect()  # at most about group_terms rows
    vocabulary = np.unique(np.array([r["term"] for r in asked], np.int64))
    vocab = spark.sparkContext.broadcast(vocabulary)
    codes = byte_codes(3, lower=True)
    schema = "key long, doc_id long, n long, terms binary, tf binary, term int, df long"
    kinds = pa.schema(
        [("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tf", pa.binary()),
         ("term", pa.int32()), ("df", pa.int64())]
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocab.value
        df = np.zeros(len(vocabulary), np.int64)
        for b in batches:
            for i, j, term, row in _terms(b.column(2), codes):
                n = np.bincount(row, minlength=j - i)
                if len(vocabulary):
                    at = np.searchsorted(vocabulary, term)
                    at[at == len(vocabulary)] = 0
                    hit = vocabulary[at] == term
                    pair, tf = np.unique(row[hit] * len(vocabulary) + at[hit], return_counts=True)
                else:
                    pair = tf = np.zeros(0, np.int64)
                doc, held = np.divmod(pair, max(len(vocabulary), 1))
                df += np.bincount(held, minlength=len(df))
                some = np.flatnonzero(n)
                edge = np.searchsorted(doc, np.append(some, j - i)).astype(np.int32) * 4
                packed = [
                    pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(edge), pa.py_buffer(v.astype("<i4"))])
                    for v in (held, tf)
                ]
                take = pa.array(some + i)
                yield batch(
                    kinds, b.column(0).take(take), b.column(1).take(take), n[some], *packed,
                    pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.int64()),
                )
        held = np.flatnonzero(df)
        none = [pa.nulls(len(held), f.type) for f in list(kinds)[:5]]
        yield batch(kinds, *none, held.astype(np.int32), df[held])

    built = materialize(rows.mapInArrow(tidy(index), schema))
    total = built.where("n is not null").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("all")).first()
    df = {r["term"]: r["df"] for r in built.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    by_item: dict[int | None, list[tuple[int, int]]] = {}
    for r in asked:
        t = int(np.searchsorted(vocabulary, r["term"]))
        if t in df:
            w = math.floor(WEIGHT_SCALE * math.log((2 * total["n"] + 2) / (2 * df[t] + 1)))
            by_item.setdefault(r["item_id"], []).append((t, w * r["n"]))
    plain = [(i, np.array(sorted(tw), np.int64).T) for i, tw in by_item.items()]
    shared = spark.sparkContext.broadcast(plain)
    size, n_docs, n_terms = len(vocabulary), total["n"], total["all"]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [Item(i, tw[0], tw[1], k) for i, tw in shared.value]
        for held in _blocks(batches, block_documents):
            block = Block(*held, size, n_docs, n_terms)
            for item in items:
                block.search(item)
        for item in items:
            n = len(item.scores)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item.item_id] * n, pa.int64()),
                        pa.array(item.keys),
                        pa.array(item.ids, mask=~item.known),
                        pa.array(item.scores),
                    ],
                    names=["item_id", "key", "doc_id", "score"],
                )

    narrow = built.where("n is not null").select("key", "doc_id", "n", "terms", "tf")
    return narrow.mapInArrow(tidy(rank), "item_id long, key long, doc_id long, score long")


def _blocks(batches: Iterator[pa.RecordBatch], block_documents: int) -> Iterator[tuple]:
    """(keys, ids, ids that are not null, lengths, document of each posting, term, tf)
    of documents that follow each other."""
    held: list[tuple] = []
    docs = postings = 0

    def joined() -> tuple:
        keys, ids, known, lengths, doc, term, tf = (np.concatenate(x) for x in zip(*held))
        return keys, ids, known, lengths, doc, term, tf

    for b in batches:
        if not b.num_rows:
            continue
        packed = b.column(3)
        edge = np.frombuffer(packed.buffers()[1], np.int32, len(packed) + 1, packed.offset * 4)
        values = []
        for c in (b.column(3), b.column(4)):
            at = np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, c.offset * 4)
            size = int(at[-1] - at[0])
            values.append(np.frombuffer(c.buffers()[2], "<i4", size // 4, int(at[0])) if size else np.zeros(0, np.int32))
        doc = np.repeat(np.arange(b.num_rows), np.diff(edge) // 4)
        known = np.asarray(b.column(1).is_valid())
        ids = np.asarray(b.column(1).fill_null(0))
        held.append((np.asarray(b.column(0)), ids, known, np.asarray(b.column(2)), doc + docs, *values))
        docs, postings = docs + b.num_rows, postings + len(doc)
        if docs >= block_documents or postings >= BLOCK_POSTINGS:
            yield joined()
            held, docs, postings = [], 0, 0
    if held:
        yield joined()
