"""Text cleaning and tokenising as JVM-side column expressions (SC8-SC12).

The reference chain for a post is: ASCII-letter tokens -> joined by one
space -> stop words removed (exact, case-sensitive word match) -> bag of
words (lower-cased words of two or more characters).  On token arrays the
same chain is ``regexp_extract_all`` -> ``filter`` -> ``transform`` ->
``filter``: no Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from insight.functions.nulls import ColumnLike, col_of

# The stop words named by the reference (its library list is
# longer; the list is a parameter everywhere).
STOP_WORDS = ("yang", "untuk", "pada", "ke")

LETTER_RUN = "[A-Za-z]+"


def flatten_whitespace(text: ColumnLike, chars: str = "\n") -> Column:
    """SC8: replace each listed character by a space (``\\n`` for posts,
    ``\\n\\t`` for page text); ``\\r`` stays, as in the reference."""
    return F.translate(col_of(text), chars, " " * len(chars))


def letter_tokens(text: ColumnLike) -> Column:
    """SC9: runs of ASCII letters, case kept (an accented letter splits a word)."""
    return F.regexp_extract_all(col_of(text), F.lit(LETTER_RUN), 0)


def join_tokens(tokens: ColumnLike) -> Column:
    """SC10: tokens joined by one space."""
    return F.array_join(col_of(tokens), " ")


def remove_stop_words(tokens: ColumnLike, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """SC11: drop tokens equal to a stop word (case-sensitive); duplicates of
    other words are kept."""
    if not stop_words:
        return col_of(tokens)
    stop = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(col_of(tokens), lambda t: ~F.array_contains(stop, t))


def bag_of_words_terms(tokens: ColumnLike, min_len: int = 2) -> Column:
    """SC12: lower-cased tokens of at least ``min_len`` characters."""
    lowered = F.transform(col_of(tokens), lambda t: F.lower(t))
    return F.filter(lowered, lambda t: F.length(t) >= min_len)


def clean_tokens(text: ColumnLike, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """SC9 -> SC11 on one text: the token array of the cleaned post."""
    return remove_stop_words(letter_tokens(text), stop_words)


def clean_text(text: ColumnLike, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """SC9 -> SC10 -> SC11: the cleaned post as one string."""
    return join_tokens(clean_tokens(text, stop_words))


def word_pattern(term: str) -> str:
    """Regex for ``term`` as a whole ASCII word, case-insensitive (search terms)."""
    if not re.fullmatch(r"[A-Za-z0-9]+", term):
        raise ValueError(f"search terms are letters/digits only: {term!r}")
    return f"(?i)(^|[^A-Za-z0-9]){term}([^A-Za-z0-9]|\\z)"


def contains_word(text: ColumnLike, term: str) -> Column:
    return col_of(text).rlike(word_pattern(term))
