"""Choosing the primary diagnosis of a condition list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.codes import primary_score

MISSING_DATE = "0000-00-00"


def score_conditions(conditions: DataFrame) -> DataFrame:
    return conditions.withColumn("score", primary_score(F.col("icd10_code"), F.col("icd10_description")))


def best_scored() -> Column:
    """The aggregate behind ``pick_primary`` over scored conditions, as one struct."""
    start = F.coalesce(F.col("start_date").cast("string"), F.lit(MISSING_DATE))
    best = F.struct("icd10_code", "icd10_description", "start_date", "score", "position")
    merit = F.struct(F.col("score"), start, -F.col("position"))
    return F.max_by(best, merit)


def pick_primary(conditions: DataFrame, keys: list[str]) -> DataFrame:
    """Best-scoring condition per key; ties go to the latest start, then the earliest position.

    ``max_by`` combines on the map side, so the choice needs no per-key sort.
    """
    return (
        score_conditions(conditions)
        .groupBy(*keys)
        .agg(best_scored().alias("best"))
        .select(
            *keys,
            F.col("best.icd10_code").alias("primary_code"),
            F.col("best.icd10_description").alias("primary_description"),
            F.col("best.start_date").alias("primary_start_date"),
            F.col("best.score").alias("primary_score"),
            F.col("best.position").alias("primary_position"),
        )
    )
