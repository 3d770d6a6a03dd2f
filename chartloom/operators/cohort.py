"""Choosing patients and encounters and their condition lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.labels import drop_zcodes
from chartloom.operators.ranking import first_by, hash_sample

PATIENT_KEY = ["patient_id"]
ENCOUNTER_KEY = ["encounter_id", "patient_id"]
MIN_PATIENT_CONDITIONS = 3
MIN_ENCOUNTER_CONDITIONS = 2
MAX_PATIENT_CONDITIONS = 20
MAX_ENCOUNTER_CONDITIONS = 10


def eligible(billable: DataFrame, keys: list[str], min_conditions: int) -> DataFrame:
    """Keys with at least ``min_conditions`` distinct billable codes.

    Distinct (key, code) first, then a count: both steps combine on the map side, so a
    patient owning a large part of the rows costs one row per code and task.
    """
    return (
        billable.select(*keys, "icd10_code")
        .distinct()
        .groupBy(*keys)
        .agg(F.count("icd10_code").alias("n_codes"))
        .where(F.col("n_codes") >= min_conditions)
    )


def eligible_patients(billable: DataFrame, min_conditions: int = MIN_PATIENT_CONDITIONS) -> DataFrame:
    """Patients with enough billable codes; Z-codes count."""
    return eligible(billable, PATIENT_KEY, min_conditions)


def eligible_encounters(billable: DataFrame, min_conditions: int = MIN_ENCOUNTER_CONDITIONS) -> DataFrame:
    """Encounters with enough billable codes; Z-codes do not count."""
    return eligible(drop_zcodes(billable, case_sensitive=True), ENCOUNTER_KEY, min_conditions)


def dedup_conditions(billable: DataFrame, keys: list[str], chosen: DataFrame | None = None) -> DataFrame:
    """One row per (key, code): earliest start, latest stop, and the least description.

    ``chosen`` restricts the work to selected keys before anything is grouped.
    """
    rows = billable if chosen is None else billable.join(chosen.select(*keys), keys, "left_semi")
    carried = [c for c in ("icd10_description", "snomed_code", "snomed_description", "encounter_id") if c not in keys]
    return rows.groupBy(*keys, "icd10_code").agg(
        *[F.min(c).alias(c) for c in carried],
        F.min("condition_start_date").alias("start_date"),
        F.max("condition_stop_date").alias("stop_date"),
    )


def cap_conditions(conditions: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` most recent conditions of each key, numbered from 1 in list order."""
    order = [F.col("start_date").desc_nulls_last(), F.col("icd10_code")]
    return first_by(conditions, keys, order, n, rank="position")


def select_patients(
    billable: DataFrame,
    n_patients: int = 50,
    min_conditions: int = MIN_PATIENT_CONDITIONS,
    max_conditions: int = MAX_PATIENT_CONDITIONS,
    *,
    include: DataFrame | None = None,
    exclude: DataFrame | None = None,
) -> DataFrame:
    """Capped condition rows of a reproducible sample of eligible patients.

    ``include`` and ``exclude`` (patient_id) are applied before the sample is cut.
    """
    patients = eligible_patients(billable, min_conditions)
    if include is not None:
        patients = keep_patients(patients, include)
    if exclude is not None:
        patients = drop_patients(patients, exclude)
    chosen = hash_sample(patients, "patient_id", n_patients)
    return cap_conditions(dedup_conditions(billable, PATIENT_KEY, chosen), PATIENT_KEY, max_conditions)


def select_encounters(
    billable: DataFrame,
    n_encounters: int = 200,
    min_conditions: int = MIN_ENCOUNTER_CONDITIONS,
    max_conditions: int = MAX_ENCOUNTER_CONDITIONS,
) -> DataFrame:
    """Capped condition rows of a reproducible sample of eligible encounters, without Z-codes."""
    clinical = drop_zcodes(billable, case_sensitive=True)
    chosen = hash_sample(eligible(clinical, ENCOUNTER_KEY, min_conditions), "encounter_id", n_encounters, ties=["patient_id"])
    return cap_conditions(dedup_conditions(clinical, ENCOUNTER_KEY, chosen), ENCOUNTER_KEY, max_conditions)


def patients_in_run(notes: DataFrame, run_id: str) -> DataFrame:
    """Distinct patients that have a note of the given run."""
    query = "SELECT DISTINCT patient_id FROM {notes} WHERE run_id = :run_id"
    return notes.sparkSession.sql(query, args={"run_id": run_id}, notes=notes)


def keep_patients(patients: DataFrame, wanted: DataFrame) -> DataFrame:
    return patients.join(wanted.select("patient_id"), "patient_id", "left_semi")


def drop_patients(patients: DataFrame, unwanted: DataFrame) -> DataFrame:
    return patients.join(unwanted.select("patient_id"), "patient_id", "left_anti")


def patient_pool(
    patients: DataFrame,
    n: int,
    *,
    include: DataFrame | None = None,
    exclude: DataFrame | None = None,
    pool_factor: int = 2,
) -> DataFrame:
    """``n`` patients by id out of the first ``pool_factor * n`` in hash order, after include/exclude.

    Sets are applied before the pool is cut, so as many come back as there are, up to ``n``.
    """
    if include is not None:
        patients = keep_patients(patients, include)
    if exclude is not None:
        patients = drop_patients(patients, exclude)
    return hash_sample(patients, "patient_id", n * pool_factor).orderBy("patient_id").limit(n)
