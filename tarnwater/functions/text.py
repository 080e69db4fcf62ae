"""Tokens and n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stop-word list (57 entries, two of them listed twice).
STOP_WORDS = (
    "a", "in", "on", "at", "and", "or",
    "to", "the", "of", "an", "by",
    "as", "is", "was", "were", "been", "be",
    "are", "for", "this", "that", "these", "those", "you", "i", "if",
    "it", "he", "she", "we", "they", "will", "have", "has",
    "do", "did", "can", "could", "who", "which", "what",
    "but", "not", "there", "no", "does", "not", "so", "ve", "their",
    "his", "her", "they", "them", "from", "with", "its",
)

# Default vocabulary size and the blanks that separate tokens.
VOCABULARY_SIZE = 5000
TOKEN_BLANKS = r"[ \t\n\r\f]+"


def lowered(text: Column) -> Column:
    """The text that tokens are cut from: no periods, lower case, NULL as empty."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("."), F.lit("")))


def tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Delete periods, lower, split on runs of blanks, drop stop words and empty tokens. NULL text gives no tokens."""
    parts = F.split(lowered(text), TOKEN_BLANKS)
    unwanted = list(dict.fromkeys(["", *stop_words]))
    return F.filter(parts, lambda t: ~t.isin(unwanted))


def ngrams(words: Column, low: int, high: int) -> Column:
    """All n-grams with low <= n <= high, shorter ones first, words joined by one blank.

    Each level pairs the level below with the words shifted by one, so the cost is linear in the text. ``words``
    should be a plain column, because every level reads it.
    """
    if not 1 <= low <= high:
        raise ValueError("need 1 <= low <= high")
    levels, grams = [], words
    for n in range(1, high + 1):
        if n > 1:
            count = F.greatest(F.size(words) - (n - 1), F.lit(0))
            heads, tails = F.slice(grams, F.lit(1), count), F.slice(words, F.lit(n), count)
            grams = F.zip_with(heads, tails, lambda a, b: F.concat_ws(" ", a, b))
        if n >= low:
            levels.append(grams)
    return F.concat(*levels)
