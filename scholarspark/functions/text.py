"""Text expressions: lengths, author counts, search normalisation, tokens, sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Search analysis: lower-case, every run of non letter/digit characters is a token break.
SEARCH_BREAK = r"[^\p{L}\p{N}]+"
# Token clean-up of the NLP normaliser: keep ASCII letters and digits only.
ASCII_STRIP_KEEP_BLANK = r"[^a-zA-Z0-9 ]"
# Sentence boundary: a run of . ! ? followed by white space.
SENTENCE_BREAK = r"[.!?]+\s+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_point_length(c) -> Column:
    return F.length(_col(c))


def author_count(c) -> Column:
    """Number of ';'-separated entries (trailing empty entries count)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.size(F.split(c, ";", -1)))


def merged_text(title, abstract) -> Column:
    """title + ' ' + abstract; NULL when either is NULL."""
    return F.concat(_col(title), F.lit(" "), _col(abstract))


def search_normalise(c) -> Column:
    return F.trim(F.regexp_replace(F.lower(_col(c)), SEARCH_BREAK, " "))


def padded(c) -> Column:
    """Normalised text with one space on each side, so phrase tests are ``contains(' a b ')``."""
    return F.concat(F.lit(" "), search_normalise(c), F.lit(" "))


def tokens(c) -> Column:
    """Search tokens; empty text gives an empty array (the normalised text is evaluated once)."""
    return F.filter(F.split(search_normalise(c), " ", -1), lambda t: t != F.lit(""))


def clean_text(c) -> Column:
    """Document clean-up: runs of white space collapsed, ends trimmed."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def whitespace_tokens(c) -> Column:
    return F.filter(F.split(clean_text(c), " ", -1), lambda t: t != F.lit(""))


def normalised_tokens(c) -> Column:
    """Whitespace tokens with non-ASCII-alphanumerics removed; empty results dropped.

    After clean-up the only white space left is single blanks between tokens, so stripping
    every character that is neither ASCII alphanumeric nor a blank from the whole text, then
    splitting, is the same as stripping token by token - with one regex pass per text.
    """
    stripped = F.regexp_replace(clean_text(c), ASCII_STRIP_KEEP_BLANK, "")
    return F.filter(F.split(stripped, " ", -1), lambda t: t != F.lit(""))


def sentence_split(c) -> Column:
    """Sentences of the cleaned text; empty text gives an empty array."""
    t = clean_text(c)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SENTENCE_BREAK, -1))
