"""Turning probabilities into described, ranked predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.evaluation import DEFAULT_THRESHOLD

CLI_DEFAULT_DESCRIPTION = "—"
SERVICE_DEFAULT_DESCRIPTION = ""


def predict_default(scored: DataFrame) -> DataFrame:
    """Hard prediction at one half, strictly above."""
    return scored.withColumn("y_pred", (F.col("y_proba") > DEFAULT_THRESHOLD).cast("int"))


def predict_threshold(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Codes at or above a threshold with their confidence to four digits."""
    return scored.where(F.col("y_proba") >= threshold).select(
        "note_id", "code", F.round("y_proba", 4).alias("confidence")
    )


def describe(
    predictions: DataFrame, dictionary: DataFrame, default: str = CLI_DEFAULT_DESCRIPTION
) -> DataFrame:
    """Add each code's description from (code_3char, description), or the default."""
    known = dictionary.select(F.col("code_3char").alias("code"), "description")
    return predictions.join(known, "code", "left").withColumn(
        "description", F.coalesce("description", F.lit(default))
    )


def responses(predictions: DataFrame, notes: DataFrame, model_name: str, n_codes: int) -> DataFrame:
    """One service response per note: ranked predictions, model, codes evaluated, note length.

    A note has at most one prediction per label, which bounds the collected list.
    """
    entry = F.struct((-F.col("confidence")).alias("order"), "code", "confidence", "description")
    grouped = predictions.groupBy("note_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    found = F.transform("entries", lambda e: F.struct(e["code"], e["confidence"], e["description"]))
    kind = "array<struct<code:string,confidence:double,description:string>>"
    return notes.join(grouped, "note_id", "left").select(
        "note_id",
        F.coalesce(found.cast(kind), F.array().cast(kind)).alias("predictions"),
        F.lit(model_name).alias("model"),
        F.lit(n_codes).alias("n_codes_evaluated"),
        F.length("note_text").alias("note_length"),
    )
