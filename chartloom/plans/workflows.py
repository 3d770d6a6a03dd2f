"""The jobs a user runs: write notes, train, cross-validate, evaluate, predict."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions import keys as ks
from chartloom.operators import evaluation as ev
from chartloom.operators import features as ft
from chartloom.operators import notes as nt
from chartloom.operators import ovr
from chartloom.operators import predict as pr
from chartloom.operators import prompts as pm
from chartloom.operators.cohort import ENCOUNTER_KEY, PATIENT_KEY, patients_in_run, select_encounters, select_patients
from chartloom.operators.dataset import Dataset
from chartloom.operators.generation import generate_notes, generated_ok, generation_failures
from chartloom.operators.labels import labels_per_note
from chartloom.operators.splits import SEED, stratified_folds
from chartloom.session import materialize
from chartloom.sources.notestore import NoteStore, write_backup

N_FEATURES = sum(block.max_features for block in ft.BLOCKS)
FOLDS_AT_ONCE = 2

# ---------------------------------------------------------------- writing notes


def patient_prompts(conditions: DataFrame, strategies: Sequence[str]) -> DataFrame:
    """One prompt row per patient and strategy, with the condition list and primary code.

    Conditions are grouped once; prompts of both strategies are written from the list. Conditions without a
    patient have no prompt.
    """
    lists = pm.both_prompt_lists(conditions.where("patient_id IS NOT NULL"), PATIENT_KEY)
    wanted = nt.strategy_fanout(lists, strategies).where(F.col("strategy").isin("multilabel", "primary_dx"))
    focused = F.col("strategy") == "primary_dx"
    return wanted.select(
        "patient_id", "strategy", "conditions", "prompt_version",
        F.when(focused, F.col("primary_code")).alias("primary_code"),
        F.when(focused, F.col("primary_prompt")).otherwise(F.col("multilabel_prompt")).alias("prompt"),
    )


def encounter_prompts(conditions: DataFrame) -> DataFrame:
    """One prompt row per encounter, with its condition list; conditions without encounter or patient have none."""
    known = conditions.where("encounter_id IS NOT NULL AND patient_id IS NOT NULL")
    lists = nt.strategy_fanout(pm.multilabel_prompt_lists(known, ENCOUNTER_KEY), [ks.ENCOUNTER_STRATEGY])
    return lists.select(*ENCOUNTER_KEY, "conditions", "strategy", "prompt_version", "prompt")


@dataclass
class GenerationRun:
    """Rows of one run, ready for the note store."""

    run_id: str
    notes: DataFrame
    labels: DataFrame
    failures: DataFrame


def _exploded(results: DataFrame) -> DataFrame:
    return results.select("*", F.inline("conditions")).drop("conditions")


def write_patient_notes(
    conditions: DataFrame,
    run_id: str,
    make_writer: Callable[[], Any],
    strategies: Sequence[str] = ks.PATIENT_STRATEGIES,
    **options: Any,
) -> GenerationRun:
    """Generate notes for capped patient conditions in every strategy."""
    results = generate_notes(patient_prompts(conditions, strategies), make_writer, **options)
    good = generated_ok(results)
    note_id = ks.patient_note_id(F.lit(run_id), F.col("patient_id"), F.col("strategy"))
    return GenerationRun(
        run_id,
        nt.patient_note_rows(good, run_id, F.current_timestamp()),
        nt.label_rows(_exploded(good), note_id, F.col("primary_code")),
        generation_failures(results).select(F.lit(run_id).alias("run_id"), "patient_id", "strategy", "error"),
    )


def write_encounter_notes(
    conditions: DataFrame, run_id: str, make_writer: Callable[[], Any], **options: Any
) -> GenerationRun:
    """Generate one note per encounter."""
    results = generate_notes(encounter_prompts(conditions), make_writer, **options)
    good = generated_ok(results)
    note_id = ks.encounter_note_id(F.lit(run_id), F.col("encounter_id"))
    return GenerationRun(
        run_id,
        nt.encounter_note_rows(good, run_id, F.current_timestamp()),
        nt.label_rows(_exploded(good), note_id, F.lit(None).cast("string")),
        generation_failures(results).select(F.lit(run_id).alias("run_id"), "encounter_id", "patient_id", "error"),
    )


@dataclass
class StoredRun:
    """What a generation job did: its rows and one row of totals."""

    run: GenerationRun
    summary: DataFrame  # run_id, n_notes, n_label_rows, n_failures, total_in, total_out, cost_usd
    stored: bool


def _finish(run: GenerationRun, store: NoteStore, backup: str | None, dry_run: bool) -> StoredRun:
    """Back up a run's notes, add notes and labels to the store unless it is a dry run, and sum the run up."""
    fixed = GenerationRun(run.run_id, materialize(run.notes, "run-notes"), run.labels, run.failures)
    if backup:
        write_backup(fixed.notes, f"{backup.rstrip('/')}/run_{run.run_id}.jsonl")
    if not dry_run:
        store.ensure_tables()
        store.append(fixed.notes, fixed.labels)
    counts = nt.run_summary(fixed.notes, fixed.labels, fixed.failures)
    summary = counts.join(nt.generation_cost(fixed.notes, ["run_id"]), "run_id", "left").na.fill(
        0, ["total_in", "total_out", "cost_usd"]
    )
    return StoredRun(fixed, summary, not dry_run)


def _confirmed(
    subjects: DataFrame, n_strategies: int, confirm: Callable[[dict[str, Any]], bool] | None
) -> bool:
    """Whether the run may go ahead: small ones always, large ones if ``confirm`` says so or is not given."""
    preview = nt.cost_preview(subjects, n_strategies).first().asDict()
    return not preview["needs_confirmation"] or confirm is None or confirm(preview)


def generation_run(
    billable: DataFrame,
    store: NoteStore,
    run_id: str,
    make_writer: Callable[[], Any],
    *,
    n_patients: int = 50,
    strategies: Sequence[str] = ks.PATIENT_STRATEGIES,
    from_run: str | None = None,
    not_from_run: str | None = None,
    backup: str | None = None,
    dry_run: bool = False,
    confirm: Callable[[dict[str, Any]], bool] | None = None,
    **options: Any,
) -> StoredRun | None:
    """One job from the pool of patients to stored notes: select, prompt, write, back up, append, sum up.

    ``from_run`` and ``not_from_run`` restrict the pool to patients with, or without, a note of that stored run.
    ``confirm`` is shown the cost preview of a large run; if it refuses, nothing is written and the result is None.
    A dry run writes notes and backup, but leaves the store alone. Give ``ledger`` (see ``generate_notes``) to
    take a run up again that died: finished prompts are not written twice. Notes and labels become visible
    together, or not at all.
    """
    include, exclude = (
        None if run is None else patients_in_run(store.notes(), run) for run in (from_run, not_from_run)
    )
    chosen = select_patients(billable, n_patients, include=include, exclude=exclude)
    conditions = materialize(chosen, "run-conditions")
    if not _confirmed(conditions.select("patient_id").distinct(), len(strategies), confirm):
        return None
    run = write_patient_notes(conditions, run_id, make_writer, strategies, **options)
    return _finish(run, store, backup, dry_run)


def encounter_generation_run(
    billable: DataFrame,
    store: NoteStore,
    run_id: str,
    make_writer: Callable[[], Any],
    *,
    n_encounters: int = 200,
    backup: str | None = None,
    dry_run: bool = False,
    confirm: Callable[[dict[str, Any]], bool] | None = None,
    **options: Any,
) -> StoredRun | None:
    """The same job with one note per encounter."""
    conditions = materialize(select_encounters(billable, n_encounters), "run-conditions")
    if not _confirmed(conditions.select(*ENCOUNTER_KEY).distinct(), 1, confirm):
        return None
    return _finish(write_encounter_notes(conditions, run_id, make_writer, **options), store, backup, dry_run)


# ---------------------------------------------------------------- training and evaluation


def train(data: Dataset, **options: Any) -> ovr.Model:
    """Fit on a dataset; the dataset's description is kept with the model."""
    model = ovr.fit(data.notes, data.labels, data.vocab, **options)
    model.info = {**data.info.first().asDict(), **model.info}
    return model


def training_vectors(model: ovr.Model, data: Dataset) -> DataFrame:
    """(note_id, indices, values, label_codes) of a dataset in the model's feature space."""
    return labels_per_note(ft.feature_vectors(data.notes, model.vocabularies), data.labels)


def evaluate(model: ovr.Model, data: Dataset) -> DataFrame:
    """Dense predictions of a model on a dataset, with truth in the model's vocabulary.

    A note's labels travel with its vector, so truth is written where the note is scored
    and dense rows are never joined.
    """
    scored = ovr.score_vectors(training_vectors(model, data), model.coefficients, N_FEATURES, truth=True)
    return pr.predict_default(scored).select("note_id", "code", "y_true", "y_proba", "y_pred")


def evaluate_sparse(model: ovr.Model, data: Dataset, floor: float = ev.THRESHOLDS[0]) -> ev.Sparse:
    """``evaluate`` without the cells that are neither true nor at ``floor``; tasks never emit them."""
    scored = ovr.score_vectors(training_vectors(model, data), model.coefficients, N_FEATURES, min_proba=floor, truth=True)
    rows = pr.predict_default(scored).select("note_id", "code", "y_true", "y_proba", "y_pred")
    codes = model.coefficients.select(F.col("label_code").alias("code"))
    return ev.sparse(rows, data.notes.select("note_id"), codes, floor)


def predict(
    notes: DataFrame, model: ovr.Model, dictionary: DataFrame, threshold: float = ev.DEFAULT_THRESHOLD
) -> DataFrame:
    """Ranked, described codes of each note at or above a threshold."""
    scored = ovr.score_notes(notes, model, min_proba=threshold)
    return ev.ranked_predictions(pr.describe(pr.predict_threshold(scored, threshold), dictionary))


# ---------------------------------------------------------------- cross-validation


def fold_vocabularies(notes: DataFrame, k: int, blocks=ft.BLOCKS) -> DataFrame:
    """(fold, block, term, feature_id, idf): the vocabulary learnt without each fold.

    ``notes`` carry a fold number. Text is counted once for all folds: a term's counts
    outside a fold are its totals less those inside it.
    """
    folds = range(1, k + 1)
    sizes = {row.fold: row["count"] for row in notes.groupBy("fold").count().collect()}
    n_notes = sum(sizes.values())
    picked = []
    for block in blocks:
        counts = ft.document_frequencies(notes, block, "fold")
        per_fold = counts.groupBy("term").agg(
            *[F.sum(F.when(F.col("fold") == f, F.col("df")).otherwise(0)).alias(f"df_{f}") for f in folds],
            *[F.sum(F.when(F.col("fold") == f, F.col("cf")).otherwise(0)).alias(f"cf_{f}") for f in folds],
        )
        df_all = sum(F.col(f"df_{f}") for f in folds)
        cf_all = sum(F.col(f"cf_{f}") for f in folds)
        frequent = materialize(
            per_fold.withColumns({"df_all": df_all, "cf_all": cf_all}).where(F.col("df_all") >= block.min_df),
            "fold-terms",
        )
        for f in folds:
            n_train = n_notes - sizes.get(f, 0)
            df = F.col("df_all") - F.col(f"df_{f}")
            kept = (
                frequent.select("term", df.alias("df"), (F.col("cf_all") - F.col(f"cf_{f}")).alias("cf"))
                .where((F.col("df") >= block.min_df) & (F.col("df") <= n_train * block.max_df))
                .orderBy(F.desc("cf"), "term")
                .limit(block.max_features)
            )
            picked.append(
                kept.select(
                    F.lit(f).alias("fold"),
                    F.lit(block.name).alias("block"),
                    "term",
                    (F.row_number().over(Window.orderBy("term")) - 1).alias("feature_id"),
                    ft.idf(F.lit(n_train), F.col("df")).alias("idf"),
                )
            )
    joint = picked[0]
    for part in picked[1:]:
        joint = joint.unionByName(part)
    return materialize(joint, "fold-vocabularies")


class _FoldWeights:
    """Turns count vectors into one fold's TF-IDF vectors, batch by batch."""

    def __init__(self, feature_of, idf_of, block_of):
        self.feature_of, self.idf_of, self.block_of = feature_of, idf_of, block_of

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        indices, values = [], []
        for terms, counts in zip(batch["terms"], batch["counts"]):
            terms = np.asarray(terms, dtype=np.int64)
            feature = self.feature_of[terms]
            known = feature >= 0
            terms, feature = terms[known], feature[known]
            raw = (1 + np.log(np.asarray(counts, dtype=float)[known])) * self.idf_of[terms]
            block = self.block_of[terms]
            lengths = np.sqrt(np.bincount(block, raw * raw, minlength=len(ft.BLOCKS)))
            indices.append(feature)
            values.append(raw / lengths[block])
        return batch.assign(indices=indices, values=values)


def _fold_weights(vocabularies: pd.DataFrame, terms: pd.DataFrame, blocks) -> _FoldWeights:
    offsets = ft.block_offsets(blocks)
    known = vocabularies.merge(terms, on=["block", "term"])
    feature_of = np.full(len(terms), -1, dtype=np.int64)
    idf_of = np.zeros(len(terms))
    block_of = np.zeros(len(terms), dtype=np.int64)
    feature_of[known["term_id"]] = known["feature_id"] + known["block"].map(offsets)
    idf_of[known["term_id"]] = known["idf"]
    block_of[known["term_id"]] = known["block"].map({block.name: i for i, block in enumerate(blocks)})
    return _FoldWeights(feature_of, idf_of, block_of)


@dataclass
class CrossValidation:
    """Out-of-fold predictions, and per fold the labels whose fit did not converge."""

    predictions: DataFrame  # note_id, fold, code, y_true, y_proba, y_pred
    not_converged: dict[int, list[str]]
    notes: DataFrame  # note_id, fold
    codes: DataFrame  # code

    def sparse(self, floor: float = ev.THRESHOLDS[0]) -> ev.Sparse:
        """For the metrics; ``floor`` may not be below the one that the folds were scored with."""
        return ev.sparse(self.predictions, self.notes, self.codes, floor)


def cross_validate(data: Dataset, **options: Any) -> DataFrame:
    """The predictions of ``cross_validation``, with a warning if any label did not converge."""
    done = cross_validation(data, **options)
    if any(done.not_converged.values()):
        warnings.warn(f"labels that did not converge, by fold: {done.not_converged}", stacklevel=2)
    return done.predictions


def cross_validation(
    data: Dataset,
    *,
    k: int = 5,
    seed: int = SEED,
    parallelism: int = FOLDS_AT_ONCE,
    floor: float | None = None,
    **options: Any,
) -> CrossValidation:
    """Out-of-fold predictions of every note, and what did not converge.

    They are dense over notes and codes; with ``floor``, cells that are neither true nor at it are never written.

    Every note is scored once, by a model whose vocabulary and weights were learnt
    without its fold. Texts are read twice in all, not twice per fold; ``parallelism`` folds
    are fitted side by side. The driver holds a solver's state for each of these, some thirty-five
    models; two are enough for one's pass to run while the other takes its step.
    """
    spark = data.notes.sparkSession
    blocks = ft.BLOCKS
    names = sorted(row.label_code for row in data.vocab.collect())
    keyed = data.labels.select(F.col("note_id").alias("key"), "label_code")
    folds = stratified_folds(keyed, k, seed).select(F.col("key").alias("note_id"), "fold")
    notes = materialize(data.notes.join(folds, "note_id").select("note_id", "note_text", "fold"), "fold-notes")
    labels = materialize(data.labels.select("note_id", "label_code"), "fold-labels")

    vocabularies = fold_vocabularies(notes, k, blocks)
    # Bounded by k * max_features rows per block.
    terms = materialize(
        vocabularies.select("block", "term")
        .distinct()
        .withColumn("term_id", F.row_number().over(Window.orderBy("block", "term")) - 1),
        "fold-term-ids",
    )
    counted = ft.known_counts(notes, terms.withColumnRenamed("term_id", "id"), blocks).join(notes.select("note_id", "fold"), "note_id")
    rows = materialize(labels_per_note(counted, labels), "fold-counts")

    local_terms = terms.toPandas()
    local_vocabularies = vocabularies.toPandas()
    per_code = labels.join(notes.select("note_id", "fold"), "note_id").groupBy("fold", "label_code").count().collect()
    sizes = {row.fold: row["count"] for row in notes.groupBy("fold").count().collect()}

    def run(fold: int) -> tuple[DataFrame, list[str]]:
        weigh = _fold_weights(local_vocabularies[local_vocabularies["fold"] == fold], local_terms, blocks)
        features = np.sort(weigh.feature_of[weigh.feature_of >= 0])
        packed = ovr.pack(rows.where(F.col("fold") != fold), names, features, weigh)
        positives: dict[str, int] = {}
        for row in per_code:
            if row.fold != fold:
                positives[row.label_code] = positives.get(row.label_code, 0) + row["count"]
        n_train = sum(n for f, n in sizes.items() if f != fold)
        coefficients, _, unsettled = ovr.fit_packed(
            spark, packed, names, positives, n_train, features, N_FEATURES, **options
        )
        held = rows.where(F.col("fold") == fold)
        scored = ovr.score_vectors(held, coefficients, N_FEATURES, min_proba=floor, vectorise=weigh, truth=True)
        return materialize(scored.withColumn("fold", F.lit(fold)), "fold-scores"), unsettled

    with ThreadPoolExecutor(max_workers=min(parallelism, k)) as pool:
        parts = list(pool.map(inheritable_thread_target(spark)(run), sorted(sizes)))
    oof = parts[0][0]
    for part, _ in parts[1:]:
        oof = oof.unionByName(part)
    predictions = pr.predict_default(oof).select("note_id", "fold", "code", "y_true", "y_proba", "y_pred")
    unsettled = {f: bad for f, (_, bad) in zip(sorted(sizes), parts, strict=True)}
    codes = data.vocab.select(F.col("label_code").alias("code"))
    return CrossValidation(predictions, unsettled, notes.select("note_id", "fold"), codes)
