"""Text helpers built from Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace, and the number of
# context tokens taken per word (also the characters taken per token).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular expression: Unicode whitespace and four separators.
WHITESPACE_CLASS = r"\s\x1c-\x1f"
UNICODE = "(?U)"
TOKENS_PER_WORD = 4
CHARS_PER_TOKEN = 4


def strip(col: Column) -> Column:
    """Trim whitespace of every kind, not just spaces, from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def squeeze(col: Column) -> Column:
    """Stripped text with every whitespace run made one space."""
    return F.trim(F.regexp_replace(col, f"{UNICODE}[{WHITESPACE_CLASS}]+", " "))


def words(col: Column) -> Column:
    """Split on whitespace runs; no empty words. NULL text has no words."""
    return split_squeezed(squeeze(F.coalesce(col, F.lit(""))))


def split_squeezed(col: Column, at_most: int | None = None) -> Column:
    """Words of text that :func:`squeeze` has already cleaned, all or the first few."""
    # Only empty text gives an empty word. No CASE, so that the text is made once.
    if at_most is None:
        return F.array_remove(F.split(col, " "), "")
    # One more piece than asked for: the last one is the uncut rest.
    return F.array_remove(F.slice(F.split(col, " ", at_most + 1), 1, at_most), "")


def count_squeezed(col: Column) -> Column:
    """Number of words in squeezed text, without building the word array."""
    spaces = F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit("")))
    return spaces + (col != "").cast("int")


def word_count(col: Column) -> Column:
    """Number of words in any text; NULL text has none."""
    found = F.regexp_count(col, F.lit(f"{UNICODE}[^{WHITESPACE_CLASS}]+"))
    return F.coalesce(found, F.lit(0))


def chunk_words(max_context_tokens: int) -> int:
    """Words per chunk. Fewer than one word per chunk is an error at call time."""
    size = max_context_tokens // TOKENS_PER_WORD
    if size < 1:
        raise ValueError(f"max_context_tokens must be at least {TOKENS_PER_WORD}")
    return size


def chunk_array(words_col: Column, max_context_tokens: int, max_chunks: int | None) -> Column:
    """Cut a word array into chunks of equal word count, at most ``max_chunks``.

    ``words_col`` should be a column, not an expression: it is read once per chunk.
    """
    size = chunk_words(max_context_tokens)
    n = F.floor((F.size(words_col) + F.lit(size - 1)) / F.lit(size)).cast("int")
    if max_chunks is not None:
        n = F.least(n, F.lit(max_chunks))
    chunks = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.array_join(F.slice(words_col, i * size + 1, F.lit(size)), " "),
    )
    # sequence(0, -1) would count downwards, hence the guard.
    return F.when(n > 0, chunks).otherwise(F.array().cast("array<string>"))


def estimate_tokens(col: Column) -> Column:
    """Rough token count: whole characters divided by four, rounded down."""
    return F.floor(F.length(col) / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def base64_text(col: Column) -> Column:
    """Base64 without the line breaks the built-in inserts on long input."""
    return F.translate(F.base64(col), "\r\n", "")


def file_stem(path: Column) -> Column:
    """A file's name without folder and suffix."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
