"""Counts that describe tables, code use and fan-out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_profile(df: DataFrame, name: str, declared: StructType | None = None) -> DataFrame:
    """One row per column: table name, row count, type and mode.

    ``declared`` gives the modes where reading files has made every column nullable.
    """
    entries = []
    for field in (declared or df.schema).fields:
        repeated = field.dataType.typeName() == "array"
        kind = field.dataType.elementType if repeated else field.dataType
        mode = "REPEATED" if repeated else ("NULLABLE" if field.nullable else "REQUIRED")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(kind.simpleString()).alias("data_type"),
                F.lit(mode).alias("mode"),
            )
        )
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.inline(F.array(*entries))
    )


def top_conditions(conditions: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent source codes."""
    return (
        conditions.groupBy(F.col("CODE").cast("string").alias("snomed_code"), F.col("DESCRIPTION").alias("description"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "snomed_code")
        .limit(n)
    )


def billable_profile(conditions: DataFrame, billable: DataFrame) -> DataFrame:
    """Sizes before and after the mapping to billable codes.

    Distinct counts go through two-level distinct aggregates, never through a set held in
    one place.
    """
    source = conditions.agg(
        F.count("*").alias("n_conditions"), F.count_distinct("CODE").alias("n_source_codes")
    ).withColumn("_one", F.lit(1))
    target = billable.agg(
        F.count("*").alias("n_billable"),
        F.count_distinct("icd10_code").alias("n_icd10_codes"),
        F.count_distinct("patient_id").alias("n_patients"),
    ).withColumn("_one", F.lit(1))
    return source.join(target, "_one").drop("_one")


def fanout_profile(labels: DataFrame, rolled: DataFrame) -> DataFrame:
    """Label rows, codes and labels per note before and after a rollup."""

    def shape(df, stage):
        return df.agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("label_code").alias("n_codes"),
            F.count_distinct("note_id").alias("n_notes"),
        ).select(
            F.lit(stage).alias("stage"), "n_rows", "n_codes", "n_notes",
            (F.col("n_rows") / F.col("n_notes")).alias("labels_per_note"),
        )

    raw = labels.select("note_id", F.col("icd10_code").alias("label_code"))
    return shape(raw, "raw").unionByName(shape(rolled, "rolled"))


def mapping_fanout(crosswalk: DataFrame) -> DataFrame:
    """How many source codes map to 1, 2, ... billable codes."""
    return (
        crosswalk.groupBy("snomed_code")
        .agg(F.count_distinct("icd10_code").alias("n_targets"))
        .groupBy("n_targets")
        .agg(F.count("*").alias("n_source_codes"))
    )


def primary_profile(notes: DataFrame) -> DataFrame:
    """Per prompt version and code family: how often the family is primary, and the version's distinct primaries."""
    primary = notes.where(F.col("primary_code").isNotNull())
    families = primary.groupBy("prompt_version", F.substring("primary_code", 1, 3).alias("family")).agg(
        F.count("*").alias("n_primary")
    )
    versions = primary.groupBy("prompt_version").agg(
        F.count("*").alias("n_notes"), F.count_distinct("primary_code").alias("n_distinct_primaries")
    )
    return families.join(versions, "prompt_version")


def model_freshness(model_info: DataFrame, current_info: DataFrame) -> DataFrame:
    """Compare what a stored model was trained on with the dataset as it is now."""
    keys = ["rollup"]
    trained = model_info.select(
        *keys, F.col("n_notes").alias("model_notes"), F.col("n_codes_kept").alias("model_codes")
    )
    now = current_info.select(
        *keys, F.col("n_notes").alias("current_notes"), F.col("n_codes_kept").alias("current_codes")
    )
    same = (F.col("model_notes") == F.col("current_notes")) & (F.col("model_codes") == F.col("current_codes"))
    return trained.join(now, keys).withColumn("is_stale", ~same)
