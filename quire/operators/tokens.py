"""Tokenising.

The reference segments each sentence in Python with a part-of-speech tagger.
Here a word is a maximal run of Unicode letters taken from the whole text with
``regexp_extract_all`` (JVM, no Python), after HTML tags are stripped; the
keep rule (English words > 2 characters, others > 1) is a row filter.  A
noun lexicon, when given, restricts words through a semi join; one with weights
and flags segments unspaced scripts (``segment``).

Stop words are removed with an anti join on the word (the reference compared
the part-of-speech flag to the list, which removed almost nothing; the
intended meaning is used).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text
from quire.functions.joins import DEFAULT_BROADCAST_ROWS, sized_broadcast
from quire.operators import segment


def tokenize(
    articles: DataFrame,
    lexicon: DataFrame | None = None,
    min_other_length: int = text.MIN_OTHER_WORD_LENGTH,
) -> DataFrame:
    """(article_id, pos, word): one row per kept token; ``pos`` is the 0-based
    position among all letter runs of the sentence.  ``min_other_length=3``
    gives the stricter variant (every word longer than 2).

    A lexicon with weights and flags (word, weight, flag) segments each run of
    letters that is not ASCII into its best path of words, and its flags decide
    what stays (``segment``); one of words only restricts the letter runs."""
    if lexicon is not None and {"weight", "flag"} <= set(lexicon.columns):
        found = segment.segment(articles.select("article_id", "sentence"), lexicon, keep=False)
        kept = segment.keep_flagged(F.col("word"), F.col("flag"), min_length=min_other_length)
        return found.where(kept).select("article_id", "pos", "word")
    tokens = articles.select(
        "article_id",
        F.posexplode(text.words(text.strip_html(F.col("sentence")))).alias("pos", "word"),
    ).where(text.keep_word(F.col("word"), min_other_length))
    if lexicon is not None:
        tokens = tokens.join(
            sized_broadcast(lexicon.select("word").distinct(), DEFAULT_BROADCAST_ROWS),
            "word",
            "left_semi",
        ).select("article_id", "pos", "word")
    return tokens


def token_arrays(
    articles: DataFrame, stop_words: DataFrame | None = None, lexicon: DataFrame | None = None
) -> DataFrame:
    """(article_id, channel_name, words, article_time) with the kept words of
    each article in text order, built inside the row (no shuffle) unless words
    are filtered by a table."""
    raw = text.words(text.strip_html(F.col("sentence")))
    arrays = articles.select(
        "article_id",
        "channel_name",
        F.filter(raw, lambda w: text.keep_word(w)).alias("words"),
        "article_time",
    )
    if stop_words is None and lexicon is None:
        return arrays
    toks = tokenize(articles.select("article_id", "sentence"), lexicon)
    if stop_words is not None:
        toks = remove_stop_words(toks, stop_words)
    kept = toks.groupBy("article_id").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("_t"))
    return (
        arrays.drop("words")
        .join(kept, "article_id", "left")
        .withColumn("words", F.coalesce(F.col("_t.word"), F.array().cast("array<string>")))
        .select("article_id", "channel_name", "words", "article_time")
    )


def remove_stop_words(
    tokens: DataFrame, stop_words: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """Anti join on the word; the list is broadcast only if it is proven
    small, otherwise a shuffle anti join."""
    stops = stop_words.select(F.col("word")).distinct()
    return tokens.join(sized_broadcast(stops, max_broadcast_rows), "word", "left_anti").select(
        *tokens.columns
    )


def stop_words_from_text(spark, path: str) -> DataFrame:
    """A stop-word file, one word per line, surrounding blanks removed; blank
    lines dropped."""
    return (
        spark.read.text(path)
        .select(F.trim(F.col("value")).alias("word"))
        .where(F.col("word") != "")
    )
