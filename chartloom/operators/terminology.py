"""From source clinical codes to billable diagnosis codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.joins import hot_keys, may_broadcast

SOURCE_VOCABULARY = "SNOMED"
TARGET_VOCABULARY = "ICD10CM"
# Fixed value: the relationship whose rows run from source concept to billable concept.
MAPPING_RELATIONSHIP = "Mapped from"


def standard_concepts(concept: DataFrame) -> DataFrame:
    """Standard source-vocabulary concepts."""
    return concept.where((F.col("vocabulary_id") == SOURCE_VOCABULARY) & (F.col("standard_concept") == "S")).select(
        F.col("concept_id").alias("snomed_concept_id"),
        F.col("concept_code").alias("snomed_code"),
        F.col("concept_name").alias("snomed_name"),
    )


def target_concepts(concept: DataFrame) -> DataFrame:
    """Billable-vocabulary concepts."""
    return concept.where(F.col("vocabulary_id") == TARGET_VOCABULARY).select(
        F.col("concept_id").alias("icd10_concept_id"),
        F.col("concept_code").alias("icd10_code"),
        F.col("concept_name").alias("icd10_name"),
    )


def mapping_edges(concept_relationship: DataFrame) -> DataFrame:
    """Source-to-billable concept pairs."""
    return concept_relationship.where(F.col("relationship_id") == MAPPING_RELATIONSHIP).select(
        F.col("concept_id_1").alias("snomed_concept_id"),
        F.col("concept_id_2").alias("icd10_concept_id"),
    )


def crosswalk(concept: DataFrame, concept_relationship: DataFrame) -> DataFrame:
    """Source code to billable code and name, one row per mapping.

    The three dictionary sides are joined with each other first. The result is as small
    as the terminology, however many conditions there are.
    """
    return (
        mapping_edges(concept_relationship)
        .join(standard_concepts(concept), "snomed_concept_id")
        .join(target_concepts(concept), "icd10_concept_id")
        .select("snomed_code", "icd10_code", F.col("icd10_name").alias("icd10_description"))
    )


def billable_conditions(
    conditions: DataFrame,
    concept: DataFrame,
    concept_relationship: DataFrame,
    *,
    salts: int = 16,
    together: str | None = None,
) -> DataFrame:
    """Conditions with every billable code their source code maps to; unmapped rows drop out.

    No job runs while the frame is built. Dictionaries that Spark estimates below its
    broadcast limit are joined one after another, so that Spark broadcasts each and the
    condition table is never shuffled. Larger ones are joined with each other first and
    meet the conditions on (code, salt): codes that hold a large share of all conditions
    are spread over ``salts`` keys, with as many copies of their few crosswalk rows; all
    other codes have one key.

    ``together`` names a column of the facts whose equal values shall be in one partition, so that
    grouping, ranking and listing by it shuffle nothing more. Broadcast dictionaries let that be
    done before rows are multiplied by their codes. Take a column without values that many rows have.
    """
    facts = conditions.select(
        F.col("PATIENT").alias("patient_id"),
        F.col("ENCOUNTER").alias("encounter_id"),
        F.col("START").alias("condition_start_date"),
        F.col("STOP").alias("condition_stop_date"),
        F.col("CODE").cast("string").alias("snomed_code"),
        F.col("DESCRIPTION").alias("snomed_description"),
    )
    sides = [standard_concepts(concept), mapping_edges(concept_relationship), target_concepts(concept)]
    if all(map(may_broadcast, sides)):
        standard, edges, target = sides
        target = target.withColumnRenamed("icd10_name", "icd10_description")
        joined = (
            _together(facts.join(standard.select("snomed_concept_id", "snomed_code"), "snomed_code"), together)
            .join(edges, "snomed_concept_id")
            .join(target, "icd10_concept_id")
        )
    else:
        joined = _together(_salted_join(facts, crosswalk(concept, concept_relationship), "snomed_code", salts), together)
    return joined.select(
        "patient_id",
        "encounter_id",
        "condition_start_date",
        "condition_stop_date",
        "snomed_code",
        "snomed_description",
        "icd10_code",
        "icd10_description",
    )


def _together(rows: DataFrame, column: str | None) -> DataFrame:
    """As many partitions as the session's shuffles have. Without a number the engine would merge them by the size of
    the rows that come in, and what is made of these is several times larger."""
    if column is None:
        return rows
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), column)


def _salted_join(facts: DataFrame, codes: DataFrame, key: str, salts: int) -> DataFrame:
    """Inner join in which only hot keys of ``facts`` are spread over several shuffle keys."""
    hot = hot_keys(facts, key)
    one, last = F.lit(0).cast("long"), F.lit(salts - 1).cast("long")
    is_hot = F.array_contains("_hot", F.col(key))
    spread = F.when(is_hot, F.pmod(F.xxhash64("patient_id", "encounter_id", "condition_start_date"), F.lit(salts)))
    copies = F.explode(F.sequence(one, F.when(is_hot, last).otherwise(one)))
    salted = facts.withColumn("_hot", hot).withColumn("_salt", F.coalesce(spread, one)).drop("_hot")
    copied = codes.withColumn("_hot", hot).withColumn("_salt", copies).drop("_hot")
    return salted.join(copied, [key, "_salt"]).drop("_salt")


def register_billable_view(
    conditions: DataFrame, concept: DataFrame, concept_relationship: DataFrame, name: str = "conditions_billable"
) -> DataFrame:
    """The billable conditions as a named view, for use from SQL."""
    billable = billable_conditions(conditions, concept, concept_relationship)
    billable.createOrReplaceTempView(name)
    return billable
