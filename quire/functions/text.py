"""Column expressions for text handling.  All are built-in Spark functions, so
they run inside whole-stage codegen on the JVM (no Python on the data path).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
# placeholder written for a missing text (the spelling is the reference's)
UNKNOWN_TEXT = "unknow"
# separator of the concatenated article sentence
SENTENCE_SEPARATOR = ","
# an HTML tag: '<', then anything but '>' on one line, then '>'.  This is the
# reference's non-greedy "<.*?>" under Python's rule that '.' stops only at '\n'.
HTML_TAG_PATTERN = "<[^>\n]*>"
# a word is a maximal run of Unicode letters
WORD_PATTERN = r"\p{L}+"
# minimum lengths kept: English words longer than 2, other words longer than 1
MIN_ASCII_WORD_LENGTH = 3
MIN_OTHER_WORD_LENGTH = 2
# characters removed before a tag list is split on ','
TAG_LIST_NOISE = '[]" '
# source tags this short (or the placeholder, or null) fall back to keywords
MAX_UNUSABLE_TAG_LENGTH = 3


def clean_text(c: Column) -> Column:
    """Null or empty text becomes the placeholder; otherwise line breaks
    (``\\n`` and ``\\r``) are deleted."""
    return F.when(c.isNull() | (c == ""), F.lit(UNKNOWN_TEXT)).otherwise(
        F.translate(c, "\n\r", "")
    )


def sentence(*cols: Column) -> Column:
    """Concatenate with ',' skipping nulls (empty strings are kept)."""
    return F.concat_ws(SENTENCE_SEPARATOR, *cols)


def strip_html(c: Column) -> Column:
    """Texts without a '<' hold no tag: they are not decoded for the pattern."""
    return F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, HTML_TAG_PATTERN, "")).otherwise(c)


def words(c: Column) -> Column:
    """All maximal letter runs of a text, in order (whole text, no prefix)."""
    return F.regexp_extract_all(c, F.lit(WORD_PATTERN), 0)


def keep_word(w: Column, min_other_length: int = MIN_OTHER_WORD_LENGTH) -> Column:
    """Keep rule for a token: English (ASCII) words need more than two
    characters, any other word more than one.

    Tokens are runs of letters, and the only ASCII letters are A-Z and a-z,
    so a token is English exactly when its UTF-8 byte length equals its
    character length -- no regex per token."""
    n = F.length(w)
    return F.when(F.octet_length(w) == n, n >= MIN_ASCII_WORD_LENGTH).otherwise(
        n >= min_other_length
    )


def tags_unusable(tags: Column) -> Column:
    return (
        tags.isNull()
        | (tags == UNKNOWN_TEXT)
        | (F.length(tags) <= MAX_UNUSABLE_TAG_LENGTH)
    )


def parse_tag_list(tags: Column) -> Column:
    """'["a", "b"]' -> ['a', 'b']: drop brackets, quotes and blanks, split on ','."""
    return F.split(F.translate(tags, TAG_LIST_NOISE, ""), ",")
