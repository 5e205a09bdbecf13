"""Word segmentation by a lexicon, for scripts that do not put blanks between words.

A lexicon is a table (word, weight, flag).  A run of letters is a lattice: each
place has an edge to the end of every lexicon word that starts there, and
one over the single character if that is not a word itself (weight ``unknown``).
The segmentation is the path of the greatest weight; of equal ones that with the
longer word first, from the left.  Runs of any length take time in proportion to
their length and the words that start at a place.

The words carry the lexicon's flags, and the keep rule of the pipeline is on them:
flags of a stop list go, a word needs more than one character, an English one
more than two, and only nouns (flag ``n...``), custom words (``x``) and English
(``eng``) stay.  With ``whole_latin`` (the default) a run of ASCII letters is one
English word, as mixed text has it; without, it is segmented like any other run.

Spark finds the runs, explodes and filters the words; only the path of each
run is found in Python, over Arrow batches of articles, because it needs each
place's best in order.  The lexicon is broadcast behind a check of its size
(``MAX_LEXICON_ROWS``); a larger one is refused, as it would have to be cut.

Null sentences and those without a letter give no word; null words of a lexicon
are left out, of rows that share a word the greatest weight counts, then the first
flag; an empty lexicon leaves single characters, which the keep rule drops.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text
from quire.functions.joins import row_count_at_most
from quire.functions.workers import ship_package

# fixed values: flags that the keep rule knows
ENGLISH, CUSTOM, NOUN = "eng", "x", "n"
MIN_WORD_LENGTH, MIN_ENGLISH_LENGTH = 2, 3
# letter runs in mixed text: ASCII letters, or other letters
MIXED_RUNS = r"[A-Za-z]+|[\p{L}&&[^A-Za-z]]+"

MAX_LEXICON_ROWS = 500_000
WEIGHT_SCALE = 1000
# articles whose words a task holds as Python objects
SLICE_ROWS = 128
# a lexicon of the words that make at least this share of a corpus has at most
# 1 / share rows, however large the corpus is
LEXICON_SHARE = 1 / 200_000
UNKNOWN_FLAG = ""


def log_weight(count: Column, total: Column) -> Column:
    """A word's weight: thousandths of the logarithm of its share, whole."""
    return F.floor(F.log(count / total) * WEIGHT_SCALE).cast("long")


def lexicon_from_counts(
    counts: DataFrame, flag: Column, word: str = "keyword", count: str = "count", share: float = LEXICON_SHARE
) -> DataFrame:
    """(word, weight, flag) of the words with at least ``share`` of all
    occurrences, and the weight of an unknown character, that of one occurrence,
    in the row of the empty word."""
    total = counts.agg(F.coalesce(F.sum(count), F.lit(1)).alias("t")).select(F.col("t").cast("double")).scalar()
    words = counts.where(F.col(count) >= total * share).select(
        F.col(word).alias("word"), log_weight(F.col(count), total).alias("weight"), flag.alias("flag")
    )
    one = counts.sparkSession.range(1).select(
        F.lit("").alias("word"), log_weight(F.lit(1), total).alias("weight"), F.lit(UNKNOWN_FLAG).alias("flag")
    )
    return words.unionByName(one)


def best_path(run: str, lattice: dict[str, int | None], unknown: int) -> list[str]:
    """The words of a run.  ``lattice``: weight of each word, None for what only
    begins words."""
    n = len(run)
    best, step = [0] * (n + 1), [1] * n
    for i in range(n - 1, -1, -1):
        end = i + 1
        weight = lattice.get(run[i], False)
        top, length = best[end] + (unknown if weight is None or weight is False else weight), 1
        while weight is not False and end < n:
            end += 1
            weight = lattice.get(run[i:end], False)
            if weight is not None and weight is not False and weight + best[end] >= top:
                top, length = weight + best[end], end - i
        best[i], step[i] = top, length
    words, i = [], 0
    while i < n:
        words.append(run[i : i + step[i]])
        i += step[i]
    return words


def build_lattice(rows: list[tuple[str, int]]) -> dict[str, int | None]:
    lattice: dict[str, int | None] = dict(rows)
    for word in list(lattice):
        for end in range(1, len(word)):
            lattice.setdefault(word[:end], None)
    return lattice


def segment(
    articles: DataFrame,
    lexicon: DataFrame,
    stop_flags: tuple[str, ...] = (),
    unknown: int | None = None,
    whole_latin: bool = True,
    keep: bool = True,
    max_lexicon_rows: int = MAX_LEXICON_ROWS,
) -> DataFrame:
    """(article_id, pos, word, flag): the words of (article_id, sentence) in order,
    ``pos`` counting from 0 before the keep rule.  ``unknown`` (None: the weight of
    the empty word, else less than any word) is the weight of a character outside
    the lexicon; ``keep=False`` returns every word."""
    spark = articles.sparkSession
    ship_package(spark)
    entries = (
        lexicon.where(F.col("word").isNotNull() & F.col("weight").isNotNull())
        .groupBy("word")
        .agg(
            F.max("weight").cast("long").alias("weight"),
            F.coalesce(F.min_by("flag", F.struct(-F.col("weight"), "flag")), F.lit(UNKNOWN_FLAG)).alias("flag"),
        )
    )
    if not row_count_at_most(entries, max_lexicon_rows):
        raise ValueError(f"a lexicon holds at most {max_lexicon_rows} words")
    rows = {r["word"]: (r["weight"], r["flag"]) for r in entries.collect()}
    given = rows.pop("", (None,))[0]
    if unknown is None:
        unknown = min([w for w, _ in rows.values()], default=0) - WEIGHT_SCALE if given is None else given
    shared = spark.sparkContext.broadcast(
        (build_lattice([(w, x) for w, (x, _) in rows.items()]), {w: f for w, (_, f) in rows.items()}, unknown, whole_latin)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, flags, unknown, whole = shared.value
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(at, SLICE_ROWS)
                words, tags, edge = [], [], [0]
                for runs in part.column(1).to_pylist():
                    for r in runs or ():
                        if whole and r.isascii():
                            words.append(r)
                            tags.append(flags.get(r, ENGLISH))
                        else:
                            path = best_path(r, lattice, unknown)
                            words += path
                            tags += [flags.get(w, UNKNOWN_FLAG) for w in path]
                    edge.append(len(words))
                pairs = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(tags, pa.string())], ["word", "flag"])
                found = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays([part.column(0), found], names=["article_id", "words"])

    pattern = MIXED_RUNS if whole_latin else text.WORD_PATTERN
    runs = F.regexp_extract_all(text.strip_html(F.col("sentence")), F.lit(pattern), 0)
    kind = articles.schema["article_id"].dataType.simpleString()
    paths = articles.select("article_id", runs.alias("runs")).mapInArrow(
        run, f"article_id {kind}, words array<struct<word: string, flag: string>>"
    )
    words = paths.select("article_id", F.posexplode("words").alias("pos", "w")).select("article_id", "pos", "w.word", "w.flag")
    return words.where(keep_flagged(F.col("word"), F.col("flag"), stop_flags)) if keep else words


def keep_flagged(word: Column, flag: Column, stop_flags: tuple[str, ...] = (), min_length: int = MIN_WORD_LENGTH) -> Column:
    """The keep rule on flagged words; ``min_length=3`` is the stricter variant."""
    kept = (F.length(word) >= min_length) & (flag.startswith(NOUN) | (flag == CUSTOM))
    kept = kept | ((flag == ENGLISH) & (F.length(word) >= MIN_ENGLISH_LENGTH))
    return kept & ~flag.isin(list(stop_flags)) if stop_flags else kept
