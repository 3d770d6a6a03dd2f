"""Note tables: versions, runs, row building, cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions import text as tx
from chartloom.functions.keys import (
    ENCOUNTER_STRATEGY,
    PROMPT_VERSIONS,
    encounter_note_id,
    pair_key,
    patient_note_id,
    seeded_hash,
)
from chartloom.operators.ranking import first_by

# Price per million tokens, and the flat per-call estimate shown before a run.
INPUT_PRICE_PER_MILLION = 0.30
OUTPUT_PRICE_PER_MILLION = 2.50
COST_PER_CALL = 0.002
SECONDS_PER_CALL = 7
CONFIRM_FROM_CALLS = 200

MODEL_NAMES = ("encounter", "patient")
MIN_NOTE_CHARS = 10


def encounter_notes(notes: DataFrame) -> DataFrame:
    """Notes written per encounter that name their encounter."""
    return notes.where((F.col("strategy") == ENCOUNTER_STRATEGY) & F.col("encounter_id").isNotNull())


def with_pair(notes: DataFrame) -> DataFrame:
    return notes.withColumn("pair", pair_key(F.col("patient_id"), F.col("strategy")))


def latest_notes(notes: DataFrame, strategies: Sequence[str] | None = None) -> DataFrame:
    """Newest note of each (patient, strategy); equal times go to the greatest note id.

    Pass ``strategies`` to leave other kinds of note (such as encounter notes) out.
    """
    if strategies is not None:
        notes = notes.where(F.col("strategy").isin(*strategies))
    return first_by(notes, ["patient_id", "strategy"], [F.desc("generated_at"), F.desc("note_id")])


def latest_run_notes(notes: DataFrame) -> DataFrame:
    """Notes of the run with the greatest id."""
    return notes.where(F.col("run_id") == notes.agg(F.max("run_id")).scalar())


def random_notes(notes: DataFrame, n: int = 3, seed: int | None = None) -> DataFrame:
    """``n`` random notes; a seed makes the choice repeatable."""
    order = F.rand() if seed is None else seeded_hash(F.col("note_id"), seed)
    return notes.orderBy(order).limit(n)


def strategy_fanout(subjects: DataFrame, strategies: Sequence[str]) -> DataFrame:
    """One row per subject and strategy, with the strategy's prompt version."""
    unknown = sorted(set(strategies) - set(PROMPT_VERSIONS))
    if unknown:
        raise ValueError(f"unknown strategy: {', '.join(unknown)}")
    options = F.array(
        *[
            F.struct(F.lit(name).alias("strategy"), F.lit(PROMPT_VERSIONS[name]).alias("prompt_version"))
            for name in strategies
        ]
    )
    return subjects.select("*", F.inline(options))


def label_rows(conditions: DataFrame, note_id: Column, primary_code: Column) -> DataFrame:
    """One label row per condition of a note; no condition is primary where the note has none."""
    return conditions.select(
        note_id.alias("note_id"),
        "icd10_code",
        "icd10_description",
        F.coalesce(F.col("icd10_code") == primary_code, F.lit(False)).alias("is_primary"),
    )


def patient_note_rows(generated: DataFrame, run_id: str, generated_at: Column) -> DataFrame:
    """Stored form of generated patient notes.

    ``generated`` holds patient_id, strategy, prompt_version, conditions, primary_code and
    the writer's output columns.
    """
    note_id = patient_note_id(F.lit(run_id), F.col("patient_id"), F.col("strategy"))
    return _note_rows(generated, run_id, note_id, generated_at, F.lit(None).cast("string"))


def encounter_note_rows(generated: DataFrame, run_id: str, generated_at: Column) -> DataFrame:
    """Stored form of generated encounter notes; they never have a primary code."""
    note_id = encounter_note_id(F.lit(run_id), F.col("encounter_id"))
    no_primary = generated.withColumn("primary_code", F.lit(None).cast("string"))
    return _note_rows(no_primary, run_id, note_id, generated_at, F.col("encounter_id"))


def _note_rows(generated, run_id, note_id, generated_at, encounter_id) -> DataFrame:
    return generated.select(
        note_id.alias("note_id"),
        F.lit(run_id).alias("run_id"),
        "patient_id",
        "strategy",
        "prompt_version",
        "model",
        generated_at.alias("generated_at"),
        "note_text",
        F.col("conditions.icd10_code").alias("labels"),
        "primary_code",
        encounter_id.alias("encounter_id"),
        "input_tokens",
        "output_tokens",
        "finish_reason",
    )


def generation_cost(notes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Token totals (missing counts as none) and their price."""
    totals = notes.groupBy(*by).agg(
        F.sum(F.coalesce("input_tokens", F.lit(0))).alias("total_in"),
        F.sum(F.coalesce("output_tokens", F.lit(0))).alias("total_out"),
    )
    cost = F.col("total_in") * INPUT_PRICE_PER_MILLION / 1e6 + F.col("total_out") * OUTPUT_PRICE_PER_MILLION / 1e6
    return totals.withColumn("cost_usd", cost)


def cost_preview(subjects: DataFrame, n_strategies: int) -> DataFrame:
    """What a generation run over ``subjects`` would take, and whether it needs confirming."""
    calls = F.col("n_calls")
    return subjects.agg((F.count("*") * n_strategies).alias("n_calls")).select(
        "n_calls",
        (calls * COST_PER_CALL).alias("est_cost_usd"),
        (calls * SECONDS_PER_CALL / 60).alias("est_minutes"),
        (calls >= CONFIRM_FROM_CALLS).alias("needs_confirmation"),
    )


def run_summary(notes: DataFrame, labels: DataFrame, failures: DataFrame) -> DataFrame:
    """Notes, label rows and failures of each run."""
    label_counts = labels.groupBy("note_id").agg(F.count("*").alias("n_labels"))
    written = (
        notes.select("note_id", "run_id")
        .join(label_counts, "note_id", "left")
        .groupBy("run_id")
        .agg(F.count("*").alias("n_notes"), F.sum(F.coalesce("n_labels", F.lit(0))).alias("n_label_rows"))
    )
    failed = failures.groupBy("run_id").agg(F.count("*").alias("n_failures"))
    return written.join(failed, "run_id", "full").na.fill(0, ["n_notes", "n_label_rows", "n_failures"])


def validate_requests(requests: DataFrame, *, strip: bool = False) -> DataFrame:
    """Flag prediction requests (note_text, model, threshold) that must be refused, and why.

    ``strip`` adds the command-line rule that a blank note is refused.
    """
    short = F.length("note_text") < MIN_NOTE_CHARS
    problems = (
        F.when(F.col("note_text").isNull() | short, "note too short")
        .when(~F.col("threshold").between(0.0, 1.0), "threshold outside [0, 1]")
        .when(~F.col("model").isin(*MODEL_NAMES), "unknown model")
    )
    if strip:
        problems = F.when(F.trim("note_text") == "", "empty note").otherwise(problems)
    return requests.withColumn("problem", problems).withColumn("is_valid", F.col("problem").isNull())


def note_previews(notes: DataFrame) -> DataFrame:
    return notes.select(
        "note_id",
        F.length("note_text").cast("long").alias("n_chars"),
        tx.preview(F.col("note_text")).alias("preview"),
    )
