"""Ratio expressions behind the classification metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, 0 where the denominator is 0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def precision(tp: Column, fp: Column) -> Column:
    return safe_ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return safe_ratio(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return safe_ratio(2 * tp, 2 * tp + fp + fn)


def ratios(prefix: str = "") -> dict[str, Column]:
    """Precision, recall and F1 of the columns tp, fp, fn."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {f"{prefix}precision": precision(tp, fp), f"{prefix}recall": recall(tp, fn), f"{prefix}f1": f1(tp, fp, fn)}


def error_share() -> Column:
    """Wrong cells among all cells of the columns tp, fp, fn, tn."""
    wrong = F.col("fp") + F.col("fn")
    return safe_ratio(wrong, F.col("tp") + wrong + F.col("tn"))
