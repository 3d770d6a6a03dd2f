"""Note labels: rollups, restriction to current notes, grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.codes import is_zcode, rollup_code


def drop_zcodes(df: DataFrame, code: str = "icd10_code", *, case_sensitive: bool = False) -> DataFrame:
    return df.where(~is_zcode(F.col(code), case_sensitive=case_sensitive))


def rollup_labels(labels: DataFrame, rollup: str = "3char") -> DataFrame:
    """(note_id, label_code, is_primary) at the chosen coarseness.

    "dirty" keeps every raw row; the others drop Z-codes and merge a note's codes that
    share the shortened form.
    """
    coded = labels.withColumn("label_code", rollup_code(F.col("icd10_code"), rollup))
    if rollup == "dirty":
        return coded.select("note_id", "label_code", "is_primary")
    return drop_zcodes(coded).groupBy("note_id", "label_code").agg(F.max("is_primary").alias("is_primary"))


def labels_of_notes(labels: DataFrame, notes: DataFrame) -> DataFrame:
    """Label rows whose note is among ``notes``."""
    return labels.join(notes.select("note_id"), "note_id").select("note_id", "label_code")


def labels_per_note(notes: DataFrame, labels: DataFrame) -> DataFrame:
    """Every note with its sorted set of labels, empty where it has none."""
    sets = (
        labels.select("note_id", "label_code")
        .distinct()
        .groupBy("note_id")
        .agg(F.sort_array(F.collect_list("label_code")).alias("label_codes"))
    )
    empty = F.array().cast("array<string>")
    return notes.join(sets, "note_id", "left").withColumn("label_codes", F.coalesce("label_codes", empty))
