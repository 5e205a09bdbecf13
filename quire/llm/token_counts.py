"""Token counts by a map-side two-tier lookup.

No piece of the model's vocabulary has a space after another character, so
no merge crosses from a word into the space behind it: a text is a row of
independent pre-tokens ``spaces + word`` and its token count is the sum of
theirs.  Tier one is a table (pre-token -> number of tokens) of the frequent
pre-tokens of the corpus, broadcast in compact form; tier two is a cache in
each Python worker for the pre-tokens the model had to encode.  Pre-tokens are
never shuffled: the frequent ones are found from summaries of bounded size,
one for each task, that merge in a tree.

Null and empty texts have 0 tokens and 0 bytes.  Repeated rows are counted
each.  Only the named columns are read; other columns stay with ``keep``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bounded_batches

MODEL = "piece_bpe_32k.model"
MARK = "▁"  # how the model writes a space; a text may hold it too

# entries of the broadcast table (about 20 bytes each) and of the summaries
FREQUENT = 32_768
SUMMARY = 16_384
MERGE_WIDTH = 16
# pre-tokens a worker remembers, about 150 bytes each; forgotten together when full
CACHED = 400_000


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = map(model.id_to_piece, range(model.vocab_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("the model has pieces that reach over a space")
    # the model puts one space before a text: "a" is one space and the letter
    one = len(model.encode("a"))
    return model, (lambda n: len(model.encode("a" + " " * n)) - one)


def pre_tokens(text: str) -> tuple[list[str], list[int]]:
    """Words that stand behind exactly one space, and the lengths of runs of
    spaces that precede nothing or more than one space: ``n`` spaces before a
    word are a word whose text starts with ``n - 1`` spaces."""
    if not text:
        return [], []
    if MARK in text:
        text = text.replace(MARK, " ")
    parts = text.split(" ")
    if "" not in parts:
        return parts, []
    words, gap, runs = [], 0, []
    for part in parts:
        if part:
            words.append(" " * gap + part)
            gap = 0
        else:
            gap += 1
    if gap:
        runs.append(gap)
    return words, runs


class Counts:
    """Token counts of pre-tokens: the broadcast table, then the worker's cache."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.model, self.spaces = _model(path)
        self.frequent, self.cache = frequent, {}

    def of(self, texts: list[str]) -> list[int]:
        split = [pre_tokens(t) for t in texts]
        seen: set[str] = set().union(*(words for words, _ in split)) if split else set()
        if len(self.cache) > CACHED:
            self.cache.clear()
        new = [w for w in seen if w not in self.frequent and w not in self.cache]
        if new:
            self.cache.update(zip(new, map(len, self.model.encode(new, num_threads=1))))
        known = {w: self.frequent.get(w) or self.cache[w] for w in seen}
        return [
            sum(map(known.__getitem__, words)) + sum(self.spaces(n) for n in runs) for words, runs in split
        ]


def _pruned(counts: Counter, size: int) -> Counter:
    return counts if len(counts) <= size else Counter(dict(counts.most_common(size)))


def frequent_pre_tokens(
    df: DataFrame, text: str = "text", size: int = FREQUENT, summary: int = SUMMARY
) -> list[str]:
    """The most frequent pre-tokens of all texts, from one summary of at most
    ``summary`` entries for each task; summaries merge ``MERGE_WIDTH`` at a
    time, so no task or driver holds more than that many."""

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(pre_tokens(t or "")[0])
            if len(counts) > 16 * summary:
                counts = _pruned(counts, 4 * summary)
        top = _pruned(counts, summary)
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(top)], pa.list_(pa.string())), pa.array([list(top.values())], pa.list_(pa.int64()))],
            names=["words", "counts"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for words, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w, k in zip(words, n):
                    counts[w] += k
            counts = _pruned(counts, 4 * size)
        top = _pruned(counts, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(top)], pa.list_(pa.string())), pa.array([list(top.values())], pa.list_(pa.int64()))],
            names=["words", "counts"],
        )

    schema = "words array<string>, counts array<bigint>"
    level, tasks = df.select(text).mapInArrow(summarize, schema), df.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // MERGE_WIDTH)
        level = level.repartition(tasks).mapInArrow(merge, schema)
    rows = level.collect()  # one row of at most ``size`` words
    return sorted({w for r in rows for w in r.words})


def count_tokens(
    df: DataFrame,
    keep: list[str],
    text: str = "text",
    path: str | None = None,
    frequent: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns, ``n_bytes`` (UTF-8) and ``n_tokens`` of every text.

    ``frequent`` lists the pre-tokens of the broadcast tier (found from ``df``
    when not given); it decides speed only, never a count."""
    path = path or public_tokenizers.path(MODEL)
    bounded_batches(df.sparkSession)
    words = frequent_pre_tokens(df, text) if frequent is None else frequent
    lengths = [len(x) for x in _model(path)[0].encode(words, num_threads=1)] if words else []
    shared = df.sparkSession.sparkContext.broadcast((words, np.array(lengths, "<u4")))
    narrow = df.select(*keep, F.col(text).alias("_text"))
    schema = narrow.drop("_text").schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, n = shared.value
        counts = Counts(path, dict(zip(listed, n.tolist())))
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns[:-1],
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(counts.of(texts), pa.int64()),
                ],
                names=[*b.schema.names[:-1], "n_bytes", "n_tokens"],
            )

    return narrow.mapInArrow(run, schema)

