"""Identifiers: note ids, (patient, strategy) pairs and hash order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIR_SEPARATOR = "::"
ENCOUNTER_STRATEGY = "encounter-multilabel"
PATIENT_STRATEGIES = ("multilabel", "primary_dx")

# Prompt version stamped on the notes of each strategy.
PROMPT_VERSIONS = {
    "multilabel": "v1-multilabel",
    "primary_dx": "v2-primary_dx",
    "encounter-multilabel": "v1-encounter-multilabel",
}


def pair_key(patient_id: Column, strategy: Column) -> Column:
    """Identity of a note that survives regeneration."""
    return F.concat(patient_id, F.lit(PAIR_SEPARATOR), strategy)


def patient_note_id(run_id: Column, patient_id: Column, strategy: Column) -> Column:
    return F.concat(run_id, F.lit("_"), patient_id, F.lit("_"), strategy)


def encounter_note_id(run_id: Column, encounter_id: Column) -> Column:
    return F.concat(run_id, F.lit("_"), encounter_id, F.lit("_encounter"))


def run_id_from(clock: Column) -> Column:
    """Run id of a UTC timestamp."""
    return F.date_format(clock, "yyyyMMdd-HHmmss")


def pair_from_note_id(note_id: Column) -> Column:
    """Pair named by a run-scoped note id; null when the id has no known strategy suffix."""
    pattern = rf"^[^_]*_(?s:(.*))_({'|'.join(PATIENT_STRATEGIES)})$"
    strategy = F.regexp_extract(note_id, pattern, 2)
    return F.when(strategy != "", pair_key(F.regexp_extract(note_id, pattern, 1), strategy))


def seeded_hash(key: Column, seed: int | str | None = None) -> Column:
    """Hex digest giving keys a reproducible pseudo-random order."""
    return F.md5(key if seed is None else F.concat(F.lit(f"{seed}:"), key))
