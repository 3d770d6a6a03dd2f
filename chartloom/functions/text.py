"""Tokenising and previewing note text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Unicode white space written out, because \s covers ASCII only.
SPACE_PATTERN = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
PREVIEW_CHARS = 200


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def spaced_words(text: Column) -> Column:
    """Lower-cased words between white space; may hold empty edges."""
    return F.split(F.lower(text), SPACE_PATTERN)


def char_windows(word: Column, low: int, high: int) -> Column:
    """Every window of ``low``..``high`` characters of a space-padded word.

    The zero-width look-ahead makes one regex pass return overlapping windows, which
    stays in generated code where a lambda over a sequence would not; windows never start
    inside a surrogate pair. Padded words are never shorter than three characters, so no
    size needs a short-word case.
    """
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.concat(
        *[F.regexp_extract_all(padded, F.lit(rf"(?![\uDC00-\uDFFF])(?=(.{{{n}}}))"), F.lit(1)) for n in range(low, high + 1)]
    )


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    """Head of a text on one line."""
    return F.translate(F.substring(text, 1, chars), "\n", " ")
