"""Text column expressions (all JVM-side, inside whole-stage codegen).

Java regular expressions treat ``\\b`` and ``\\w`` differently from RE2 on
non-ASCII text: ``élove`` does not match ``\\blove\\b`` in Java but does in RE2.
Functions that take a ``boundary`` argument therefore offer ``"java"`` (the
``\\b`` form the analyses were written with) and ``"ascii"`` (explicit ASCII
word classes, identical in every regex dialect).  ``WHITESPACE`` spells out
Java's ``\\s`` so the same pattern means the same thing everywhere.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \s, written out: space, tab, newline, vertical tab, form feed, return.
WHITESPACE = r"[ \t\n\x0B\f\r]+"
ASCII_WORD = "A-Za-z0-9_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_count(text) -> Column:
    """Number of maximal runs of non-whitespace characters; 0 for empty text."""
    return F.size(F.array_remove(F.split(_col(text), WHITESPACE), ""))


def word_regex(word: str, boundary: str = "java") -> str:
    """Case-insensitive whole-word pattern for ``word``."""
    w = re.escape(word)
    if boundary == "java":
        return rf"(?i)\b{w}\b"
    if boundary == "ascii":
        return rf"(?i)(?<![{ASCII_WORD}]){w}(?![{ASCII_WORD}])"
    raise ValueError(f"boundary must be 'java' or 'ascii', not {boundary!r}")


def has_word(text, word: str, boundary: str = "java") -> Column:
    return _col(text).rlike(word_regex(word, boundary))


def word_occurrences(text, word: str, boundary: str = "java") -> Column:
    """Occurrences of ``word`` in ``text`` (0 for null text)."""
    return F.coalesce(F.regexp_count(_col(text), F.lit(word_regex(word, boundary))), F.lit(0))


def lines_with_word(text, word: str, boundary: str = "java") -> Column:
    """Number of newline-separated lines of ``text`` that hold ``word``."""
    pattern = word_regex(word, boundary)
    return F.coalesce(
        F.size(F.filter(F.split(_col(text), "\n"), lambda line: line.rlike(pattern))), F.lit(0))


def letter_count(text, letter: str = "a") -> Column:
    """Case-insensitive count of one letter; null text counts 0."""
    if len(letter) != 1:
        raise ValueError("letter must be a single character")
    low = F.lower(_col(text))
    return F.coalesce(
        (F.length(low) - F.length(F.replace(low, F.lit(letter.lower()), F.lit("")))).cast("int"),
        F.lit(0))


def strip_punctuation(text) -> Column:
    """Drop every character that is neither an ASCII word character nor whitespace."""
    return F.regexp_replace(_col(text), r"[^A-Za-z0-9_ \t\n\x0B\f\r]", "")


def title_case(text) -> Column:
    """``initcap(lower(trim(text)))``."""
    return F.initcap(F.lower(F.trim(_col(text))))
