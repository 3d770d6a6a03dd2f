"""Expressions over diagnosis codes and their descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Admission likelihood per code chapter.
# (first letter, lowest second character, highest second character, weight); first match wins.
CHAPTER_WEIGHTS = (
    ("I", "0", "9", 4),
    ("J", "0", "9", 4),
    ("K", "2", "9", 4),
    ("K", "0", "1", 0),
    ("S", "0", "9", 4),
    ("T", "0", "9", 4),
    ("A", "0", "9", 3),
    ("B", "0", "9", 3),
    ("C", "0", "9", 3),
    ("D", "0", "4", 3),
    ("D", "5", "9", 3),
    ("E", "0", "9", 3),
    ("N", "0", "9", 3),
    ("O", "0", "9", 2),
    ("R", "0", "9", 2),
    ("G", "0", "9", 2),
    ("H", "0", "9", 1),
    ("L", "0", "9", 1),
    ("M", "0", "9", 1),
    ("F", "0", "9", 1),
    ("Z", "0", "9", 0),
)

# Phrases that mark a description as an unlikely admission cause.
TRIVIAL_PHRASES = (
    "other specified",
    "other disorders",
    "unspecified",
    "edentulous",
    "in remission",
    "history of",
    "personal history",
    "screening for",
)

DEFAULT_CHAPTER_WEIGHT = 1
ADMINISTRATIVE_SCORE = -100
ROLLUP_LENGTHS = {"3char": 3, "chapter": 1, "dirty": None}


def is_zcode(code: Column, *, case_sensitive: bool = False) -> Column:
    """Administrative (Z-chapter) code test."""
    return (code if case_sensitive else F.upper(code)).startswith("Z")


def rollup_code(code: Column, rollup: str) -> Column:
    """Code shortened to its family ("3char"), chapter letter, or left as it is ("dirty")."""
    if rollup not in ROLLUP_LENGTHS:
        raise ValueError(f"unknown rollup {rollup!r}; expected one of {sorted(ROLLUP_LENGTHS)}")
    length = ROLLUP_LENGTHS[rollup]
    return code if length is None else F.substring(code, 1, length)


def chapter_weight(code: Column) -> Column:
    """Weight of a code's chapter; empty and unmatched codes get the default."""
    letter = F.upper(F.substring(code, 1, 1))
    second = F.when(F.length(code) > 1, F.substring(code, 2, 1)).otherwise("0")

    def add_rule(chain, rule):
        first, low, high, weight = rule
        return chain.when((letter == first) & second.between(low, high), weight)

    return reduce(add_rule, CHAPTER_WEIGHTS, F).otherwise(DEFAULT_CHAPTER_WEIGHT)


def trivial_penalty(description: Column) -> Column:
    """Minus two for every trivial phrase the description contains."""
    text = F.lower(description)
    hits = [text.contains(phrase).cast("int") for phrase in TRIVIAL_PHRASES]
    return F.coalesce(reduce(lambda a, b: a + b, hits) * -2, F.lit(0))


def specificity_bonus(code: Column) -> Column:
    """One point for codes written with more than four characters."""
    return F.when(F.length(code) > 4, 1).otherwise(0)


def primary_score(code: Column, description: Column) -> Column:
    """How well a condition would serve as the primary diagnosis of an admission."""
    return F.when(is_zcode(code), ADMINISTRATIVE_SCORE).otherwise(
        chapter_weight(code) + trivial_penalty(description) + specificity_bonus(code)
    )
