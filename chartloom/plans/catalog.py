"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the given tables whole, through the clinical tables derived in
``testtables``. Doubles are rounded and dates and arrays rendered as text, so results
compare exactly across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chartloom.functions import codes as cd
from chartloom.functions import keys as ks
from chartloom.operators import certificate as cf
from chartloom.operators import cohort as co
from chartloom.operators import dataset as ds
from chartloom.operators import evaluation as ev
from chartloom.operators import features as ft
from chartloom.operators import generation as gn
from chartloom.operators import labels as lb
from chartloom.operators import notes as nt
from chartloom.operators import ovr
from chartloom.operators import picker as pk
from chartloom.operators import predict as pr
from chartloom.operators import profiling as pf
from chartloom.operators import prompts as pm
from chartloom.operators import ranking as rk
from chartloom.operators import splits as sp
from chartloom.operators import terminology as tm
from chartloom.plans import workflows as wf
from chartloom.plans.testtables import clinical_table, test_table
from chartloom.plans.writers import template_writer
from chartloom.session import materialize, scratch_path, ship_package
from chartloom.sources import landing as ld
from chartloom.sources import results as rs
from chartloom.sources.notestore import NoteStore, read_backup, write_backup
from chartloom.streaming import latest as st_latest
from chartloom.streaming import scoring as st_scoring

RUN_ID = "20260201-080000"
N_FEATURES = sum(block.max_features for block in ft.BLOCKS)
ROLLUPS = ("dirty", "3char", "chapter")
Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def text_dates(df: DataFrame) -> DataFrame:
    """All date columns as text."""
    return df.select(*[F.col(c).cast("string").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes])


def _nullable(schema: StructType) -> StructType:
    """The schema as a reader of files declares it."""
    return StructType([StructField(f.name, f.dataType) for f in schema])


def hash_unit(text: Column) -> Column:
    """A reproducible number in [0, 1] from a text."""
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("double") / 16777215.0


def hashed_predictions(dense: DataFrame) -> DataFrame:
    """Dense truth rows with hash-derived probabilities, higher where the code is true."""
    unit = hash_unit(F.concat("note_id", F.lit("|"), "code"))
    proba = (
        F.when(F.col("y_true") == 1, 0.25 + 0.75 * unit)
        .when(F.col("code").startswith("Q"), 0.45 * unit)
        .otherwise(0.62 * unit)
    )
    return pr.predict_default(dense.withColumn("y_proba", proba))


def hashed_coefficients(vocabularies: DataFrame, codes: DataFrame) -> DataFrame:
    """Coefficients in [-1, 1] derived from (block, term, code), one dense row per code."""
    ship_package(vocabularies.sparkSession)
    offsets = ft.block_offsets()
    names = codes.agg(F.sort_array(F.collect_list("label_code"))).scalar()
    start = F.when(F.col("block") == "word", offsets["word"]).otherwise(offsets["char"])
    cells = (
        vocabularies.withColumn("_codes", names)
        .select("block", "term", (F.col("feature_id") + start).alias("feature_id"), F.explode("_codes").alias("label_code"))
        .select(
            "label_code",
            "feature_id",
            (hash_unit(F.concat("block", F.lit(":"), "term", F.lit("|"), "label_code")) * 2 - 1).alias("w"),
        )
    )

    def dense(group: pd.DataFrame) -> pd.DataFrame:
        weights = np.zeros(N_FEATURES)
        weights[group["feature_id"].to_numpy()] = group["w"].to_numpy()
        return pd.DataFrame({"label_code": group["label_code"].iloc[:1], "intercept": [-0.5], "weights": [weights]})

    return materialize(cells.groupBy("label_code").applyInPandas(dense, ovr.COEFFICIENT_SCHEMA), "hashed")


class Inputs:
    """The clinical tables of one data directory and the usual steps built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._datasets: dict[tuple[str, str], ds.Dataset] = {}

    def table(self, name: str) -> DataFrame:
        return test_table(self.spark, self.sf_dir, name)

    def clinical(self, name: str) -> DataFrame:
        return clinical_table(self.spark, self.sf_dir, name)

    @cached_property
    def conditions(self):
        return self.clinical("conditions")

    @cached_property
    def concept(self):
        return self.clinical("concept")

    @cached_property
    def edges(self):
        return self.clinical("concept_relationship")

    @cached_property
    def billable(self):
        return tm.billable_conditions(self.conditions, self.concept, self.edges)

    @cached_property
    def notes(self):
        return self.clinical("notes_synth")

    @cached_property
    def labels(self):
        return self.clinical("notes_labels")

    @cached_property
    def labels_3char(self):
        return lb.rollup_labels(self.labels, "3char")

    @cached_property
    def texts(self):
        return self.table("documents").select(F.col("doc_id").cast("string").alias("note_id"), F.col("text").alias("note_text"))

    # ---- patient conditions

    @cached_property
    def patient_conditions(self):
        rows = tm.billable_conditions(self.conditions, self.concept, self.edges, together="patient_id")
        return co.cap_conditions(co.dedup_conditions(rows, co.PATIENT_KEY), co.PATIENT_KEY, co.MAX_PATIENT_CONDITIONS)

    @cached_property
    def encounter_conditions(self):
        clinical = lb.drop_zcodes(self.billable, case_sensitive=True)
        chosen = co.eligible(clinical, co.ENCOUNTER_KEY, co.MIN_ENCOUNTER_CONDITIONS)
        return co.cap_conditions(co.dedup_conditions(clinical, co.ENCOUNTER_KEY, chosen), co.ENCOUNTER_KEY, co.MAX_ENCOUNTER_CONDITIONS)

    # ---- split and datasets

    @cached_property
    def current(self):
        latest = nt.latest_notes(self.notes, ks.PATIENT_STRATEGIES)
        return materialize(nt.with_pair(latest).select("note_id", F.col("pair").alias("key")), "current")

    @cached_property
    def old_split(self):
        return self.clinical("old_split")

    @cached_property
    def pair_labels(self):
        found = self.current.join(self.labels_3char, "note_id").select("key", "label_code")
        return materialize(found, "pair-labels")

    @cached_property
    def split(self):
        """The merged split, stored as it would be between jobs."""
        return materialize(sp.merge_split(self.old_split, self.current, self.pair_labels), "split")

    def dataset(self, bucket: str, rollup: str = "3char"):
        key = (bucket, rollup)
        if key not in self._datasets:
            self._datasets[key] = ds.load_patient_dataset(
                self.notes, self.labels, self.split, bucket=bucket, rollup=rollup
            )
        return self._datasets[key]

    @cached_property
    def encounter_ids(self):
        return nt.encounter_notes(self.notes).select(F.col("encounter_id").alias("key"))

    def encounter_dataset(self, bucket: str):
        key = (bucket, "encounter")
        if key not in self._datasets:
            split = materialize(sp.encounter_split(self.encounter_ids), "encounter-split")
            self._datasets[key] = ds.load_encounter_dataset(self.notes, self.labels, split, bucket=bucket)
        return self._datasets[key]

    @cached_property
    def dev(self):
        return self.dataset("dev")

    @cached_property
    def folds(self):
        return sp.stratified_folds(self.dev.labels.withColumnRenamed("note_id", "key"), 5)

    def _predictions(self, bucket: str, rollup: str = "3char"):
        data = self.dataset(bucket, rollup)
        return hashed_predictions(ds.binarize(data.notes, data.labels, data.vocab))

    @cached_property
    def held_out(self):
        return self._predictions("test")

    def _sparse(self, bucket: str, rollup: str = "3char", floor: float = ev.DEFAULT_THRESHOLD):
        data = self.dataset(bucket, rollup)
        codes = data.vocab.select(F.col("label_code").alias("code"))
        return ev.sparse(self._predictions(bucket, rollup), data.notes.select("note_id"), codes, floor)

    @cached_property
    def held_out_sparse(self):
        return self._sparse("test")

    def oof_sparse(self, floor: float = ev.DEFAULT_THRESHOLD):
        """Only kept cells meet their note's fold."""
        folds = self.folds.select(F.col("key").alias("note_id"), "fold")
        kept = self._sparse("dev", floor=floor)
        return ev.Sparse(kept.rows.join(folds, "note_id"), kept.notes.join(folds, "note_id"), kept.codes, floor)

    @cached_property
    def stats(self):
        return ev.per_code_stats(self.held_out_sparse)

    # ---- model with hash-derived coefficients over a vocabulary learnt from dev

    @cached_property
    def hashed_model(self):
        vocabularies = materialize(ft.fit_vocabularies(self.dev.notes), "vocabulary")
        return vocabularies, hashed_coefficients(vocabularies, self.dev.vocab)

    def hash_scored(self, notes: DataFrame, min_proba: float | None = None) -> DataFrame:
        vocabularies, coefficients = self.hashed_model
        return ovr.score_vectors(ft.feature_vectors(notes, vocabularies), coefficients, N_FEATURES, min_proba=min_proba)

    @cached_property
    def dictionary(self):
        """Descriptions of three of every four families."""
        family = F.substring("icd10_code", 1, 3)
        known = self.labels.where(F.substring(F.md5("icd10_code"), 1, 1) < "c")
        return known.groupBy(family.alias("code_3char")).agg(F.min("icd10_description").alias("description"))


BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {}
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its own name."""
    BUILDERS[build.__name__] = build
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# ------------------------------------------------------------------ terminology


@query
def conditions_billable(x):
    return text_dates(x.billable)


@query
def standard_concepts(x):
    return tm.standard_concepts(x.concept)


@query
def target_concepts(x):
    return tm.target_concepts(x.concept)


@query
def mapping_edges(x):
    return tm.mapping_edges(x.edges)


# ------------------------------------------------------------------ labels


@query
def labels_3char(x):
    return lb.rollup_labels(x.labels, "3char")


@query
def labels_chapter(x):
    return lb.rollup_labels(x.labels, "chapter")


@query
def labels_dirty(x):
    return lb.rollup_labels(x.labels, "dirty")


@query
def zcode_filter(x):
    kept = lb.drop_zcodes(x.labels).select("note_id", "icd10_code", F.lit("any case").alias("rule"))
    strict = lb.drop_zcodes(x.labels, case_sensitive=True).select("note_id", "icd10_code", F.lit("upper case").alias("rule"))
    return kept.unionByName(strict)


@query
def labels_latest(x):
    return lb.labels_of_notes(x.labels_3char, nt.latest_notes(x.notes))


@query
def labels_per_note(x):
    sets = lb.labels_per_note(x.notes.select("note_id"), x.labels_3char)
    return sets.select("note_id", F.array_join("label_codes", ",").alias("label_codes"))


# ------------------------------------------------------------------ note rows and ids


@query
def encounter_notes(x):
    return nt.encounter_notes(x.notes).select("note_id", "patient_id", "encounter_id", "note_text")


@query
def pair_keys(x):
    return nt.with_pair(x.notes).select("note_id", "pair")


@query
def note_ids(x):
    by_patient = ks.patient_note_id(F.col("run_id"), F.col("patient_id"), F.col("strategy"))
    by_encounter = ks.encounter_note_id(F.col("run_id"), F.col("encounter_id"))
    made = F.when(F.col("encounter_id").isNotNull(), by_encounter).otherwise(by_patient)
    return x.notes.select("note_id", made.alias("made_id"), ks.run_id_from(F.col("generated_at")).alias("clock_run_id"))


@query
def legacy_id_to_pair(x):
    made = ks.patient_note_id(F.col("run_id"), F.concat(F.lit("p_"), "patient_id"), F.col("strategy"))
    ids = x.notes.select("note_id", made.alias("made_id"))
    return ids.withColumn("pair", ks.pair_from_note_id(F.col("made_id"))).where("pair IS NOT NULL")


@query
def latest_notes(x):
    return nt.latest_notes(x.notes).select("note_id", "patient_id", "strategy", "prompt_version", "note_text")


@query
def latest_run_notes(x):
    return nt.latest_run_notes(x.notes).select("note_id", "run_id", "strategy", "note_text")


@query
def random_sample(x):
    return nt.random_notes(nt.latest_run_notes(x.notes), 3, seed=7).select("note_id", "strategy", "note_text", "output_tokens")


@query
def validate_notes(x):
    checked = nt.validate_requests(x.clinical("prediction_requests"))
    return checked.select("note_id", "is_valid", F.coalesce("problem", F.lit("")).alias("problem"))


@query
def note_preview(x):
    return nt.note_previews(x.notes)


# ------------------------------------------------------------------ scoring of conditions


def _coded(x):
    return x.billable.select("icd10_code", "icd10_description").distinct()


@query
def chapter_weight(x):
    return _coded(x).select("icd10_code", cd.chapter_weight(F.col("icd10_code")).alias("weight")).distinct()


@query
def trivial_penalty(x):
    return _coded(x).select("icd10_description", cd.trivial_penalty(F.col("icd10_description")).alias("penalty")).distinct()


@query
def primary_score(x):
    return pk.score_conditions(_coded(x))


@query
def pick_primary(x):
    return text_dates(pk.pick_primary(x.patient_conditions, co.PATIENT_KEY))


@query
def condition_lines(x):
    return pm.with_condition_lines(x.patient_conditions).select("patient_id", "position", "line")


@query
def prompt_multilabel(x):
    return pm.multilabel_prompts(x.encounter_conditions, co.ENCOUNTER_KEY)


@query
def prompt_primary(x):
    return pm.primary_dx_prompts(x.patient_conditions, co.PATIENT_KEY)


# ------------------------------------------------------------------ cohorts


@query
def eligible_patients(x):
    return co.eligible_patients(x.billable)


@query
def eligible_encounters(x):
    return co.eligible_encounters(x.billable)


@query
def dedup_conditions(x):
    deduped = co.dedup_conditions(x.billable, co.PATIENT_KEY, co.eligible_patients(x.billable))
    return text_dates(deduped)


@query
def cap_conditions(x):
    return text_dates(x.encounter_conditions)


@query
def hash_sample(x):
    return rk.hash_sample(co.eligible_encounters(x.billable), "encounter_id", 200)


@query
def selected_patients(x):
    return text_dates(co.select_patients(x.billable))


@query
def selected_encounters(x):
    return text_dates(co.select_encounters(x.billable))


@query
def patients_from_run(x):
    return co.keep_patients(co.eligible_patients(x.billable), co.patients_in_run(x.notes, "r000000"))


@query
def patients_exclude_run(x):
    return co.drop_patients(co.eligible_patients(x.billable), co.patients_in_run(x.notes, "r000000"))


@query
def patient_pool(x):
    run = co.patients_in_run(x.notes, "r000000")
    patients = co.eligible_patients(x.billable)
    pools = [
        co.patient_pool(patients, 30).withColumn("kind", F.lit("plain")),
        co.patient_pool(patients, 30, include=run).withColumn("kind", F.lit("include")),
        co.patient_pool(patients, 30, exclude=run).withColumn("kind", F.lit("exclude")),
    ]
    return pools[0].unionByName(pools[1]).unionByName(pools[2])


# ------------------------------------------------------------------ generation


@query
def strategy_fanout(x):
    return nt.strategy_fanout(co.eligible_patients(x.billable).select("patient_id"), ks.PATIENT_STRATEGIES)


@query
def label_rows(x):
    conditions = materialize(x.patient_conditions, "patient-conditions")
    picked = conditions.join(pk.pick_primary(conditions, co.PATIENT_KEY), co.PATIENT_KEY)
    both = nt.strategy_fanout(picked, ks.PATIENT_STRATEGIES)
    note_id = ks.patient_note_id(F.lit(RUN_ID), F.col("patient_id"), F.col("strategy"))
    primary = F.when(F.col("strategy") == "primary_dx", F.col("primary_code"))
    return nt.label_rows(both, note_id, primary)


def _templated(x):
    """Patient notes of both strategies written by the deterministic writer."""
    return wf.patient_prompts(x.patient_conditions, ks.PATIENT_STRATEGIES)


@query
def note_rows(x):
    written = _templated(x).select(
        "*",
        F.col("prompt").alias("note_text"),
        F.length("prompt").cast("long").alias("input_tokens"),
        F.lit(0).cast("long").alias("output_tokens"),
        F.lit("none").alias("model"),
        F.lit("STOP").alias("finish_reason"),
    )
    rows = nt.patient_note_rows(written, RUN_ID, F.lit("2026-02-01 08:00:00").cast("timestamp"))
    return rows.select(
        "note_id", "run_id", "patient_id", "strategy", "prompt_version", "model", "note_text",
        F.array_join(F.array_sort("labels"), ",").alias("labels"),
        F.coalesce("primary_code", F.lit("")).alias("primary_code"),
        F.coalesce("encounter_id", F.lit("")).alias("encounter_id"),
        "input_tokens", "output_tokens", "finish_reason",
    )


@query
def generate_notes(x):
    return gn.generate_notes(_templated(x).drop("conditions"), template_writer, pause=0).drop("prompt")


RUN_NOTE_COLUMNS = (
    "note_id", "run_id", "patient_id", "strategy", "prompt_version", "model", "note_text", "input_tokens", "output_tokens", "finish_reason",
)


@query
def encounter_note_rows(x):
    """Notes of every eligible encounter by the deterministic writer, in stored form."""
    written = wf.write_encounter_notes(x.encounter_conditions, RUN_ID, template_writer, pause=0).notes
    return written.select(
        *RUN_NOTE_COLUMNS, "encounter_id",
        F.array_join(F.array_sort("labels"), ",").alias("labels"),
        F.coalesce("primary_code", F.lit("")).alias("primary_code"),
    )


def _second_run(x):
    """A store with every given note, and a generation run after it for patients of none of run r000000, with a backup."""
    store = NoteStore(x.spark, scratch_path(x.spark, "store"))
    store.ensure_tables()
    store.append(x.notes, x.labels)
    backup = scratch_path(x.spark, "backup")
    done = wf.generation_run(
        x.billable, store, RUN_ID, template_writer, not_from_run="r000000", backup=backup, pause=0
    )
    return store, f"{backup}/run_{RUN_ID}.jsonl", done


@query
def generation_run(x):
    """Stored notes of the run with their label counts, beside the text in the backup."""
    store, backup, _ = _second_run(x)
    labels = store.labels().groupBy("note_id").agg(
        F.count("*").alias("n_labels"), F.count_if("is_primary").alias("n_primary")
    )
    saved = read_backup(x.spark, backup).select("note_id", F.col("note_text").alias("saved_text"))
    stored = store.notes().where(F.col("run_id") == RUN_ID).join(labels, "note_id", "left").join(saved, "note_id", "left")
    return stored.select(
        *RUN_NOTE_COLUMNS, "n_labels", "n_primary", F.equal_null("note_text", "saved_text").alias("is_backed_up")
    )


@query
def generation_totals(x):
    """Totals of the run."""
    return rounded(_second_run(x)[2].summary)


@query
def generation_failures(x):
    return gn.generation_failures(x.clinical("generation_outcome"))


@query
def generation_cost(x):
    return rounded(nt.generation_cost(x.notes, ["run_id"]))


@query
def cost_preview(x):
    return rounded(nt.cost_preview(co.eligible_patients(x.billable), len(ks.PATIENT_STRATEGIES)))


@query
def run_summary(x):
    outcome = x.clinical("generation_outcome")
    written = x.notes.join(gn.generated_ok(outcome).select("note_id"), "note_id", "left_semi")
    return nt.run_summary(written, x.labels, gn.generation_failures(outcome))


# ------------------------------------------------------------------ splits


@query
def split_carried(x):
    return sp.carried(x.old_split, x.current)


@query
def split_new(x):
    return sp.new_keys(x.old_split, x.current)


@query
def split_orphaned(x):
    return sp.orphaned(x.old_split, x.current)


@query
def split_merged(x):
    return x.split


@query
def stratified_split(x):
    fresh = x.pair_labels.join(sp.new_keys(x.old_split, x.current), "key", "left_semi")
    return sp.stratified_split(fresh)


@query
def encounter_split(x):
    return sp.encounter_split(x.encounter_ids)


@query
def split_report(x):
    return sp.split_report(x.old_split, x.current, x.split, x.pair_labels)


@query
def codes_test_not_dev(x):
    # Nine in ten for test, so that some raw codes miss dev.
    split = sp.encounter_split(x.encounter_ids, test_fraction=0.9)
    keyed = nt.encounter_notes(x.notes).select("note_id", F.col("encounter_id").alias("key"))
    raw = keyed.join(lb.rollup_labels(x.labels, "dirty"), "note_id").select("key", "label_code").distinct()
    return sp.codes_test_not_dev(split, raw)


@query
def kfold_assign(x):
    return x.folds


@query
def stratified_iterative(x):
    fresh = x.pair_labels.join(sp.new_keys(x.old_split, x.current), "key", "left_semi")
    return sp.iterative_split(fresh)


@query
def kfold_iterative(x):
    return sp.iterative_folds(x.dev.labels.withColumnRenamed("note_id", "key"), 5)


@query
def fold_balance(x):
    return sp.fold_balance(x.folds, x.dev.labels.withColumnRenamed("note_id", "key"))


# ------------------------------------------------------------------ datasets


@query
def bucket_notes(x):
    return ds.bucket_notes(x.current.select("note_id", "key"), x.split, "all")


@query
def label_vocab(x):
    dev = ds.bucket_notes(x.current, x.split, "dev")
    return ds.label_vocab(lb.labels_of_notes(x.labels_3char, dev))


@query
def nonempty_notes(x):
    return x.dev.notes


@query
def dataset_info(x):
    return rounded(ds.dataset_infos(x.current, x.labels, x.split, rollups=ROLLUPS))


@query
def encounter_dataset_info(x):
    split = sp.encounter_split(x.encounter_ids)
    current = nt.encounter_notes(x.notes).select("note_id", F.col("encounter_id").alias("key"))
    return rounded(ds.dataset_infos(current, x.labels, split, rollups=("3char",)))


@query
def binarize_long(x):
    return ds.binarize(x.dev.notes, x.dev.labels, x.dev.vocab)


@query
def rebinarize(x):
    # Labels of the test notes in full, against the vocabulary learnt on dev.
    test = x.dataset("test")
    return ds.binarize(test.notes, lb.labels_of_notes(x.labels_3char, test.notes), x.dev.vocab)


# ------------------------------------------------------------------ metrics


@query
def confusion_per_code(x):
    return ev.confusion_per_code(x.held_out_sparse)


@query
def per_code_prf(x):
    return x.stats


@query
def micro_scores(x):
    return rounded(ev.micro_scores(x.held_out_sparse))


@query
def macro_scores(x):
    return rounded(ev.macro_scores(x.held_out_sparse))


@query
def subset_accuracy(x):
    return rounded(ev.subset_accuracy(x.held_out_sparse))


@query
def hamming_loss(x):
    return rounded(ev.hamming_loss(x.held_out_sparse))


@query
def fold_scores(x):
    return rounded(ev.fold_scores(x.oof_sparse()))


@query
def fold_summary(x):
    return rounded(ev.fold_summary(ev.fold_scores(x.oof_sparse())))


@query
def oof_scores(x):
    return rounded(ev.score_table(x.oof_sparse()))


@query
def threshold_sweep(x):
    return rounded(ev.threshold_sweep(x.oof_sparse(ev.THRESHOLDS[0])))


@query
def best_threshold(x):
    return rounded(ev.best_threshold(ev.threshold_sweep(x.oof_sparse(ev.THRESHOLDS[0]))))


@query
def cv_headline(x):
    best = ev.best_threshold(ev.threshold_sweep(x.oof_sparse(ev.THRESHOLDS[0])))
    return rounded(ev.cv_headline(ev.fold_summary(ev.fold_scores(x.oof_sparse())), best))


@query
def f1_summary(x):
    return ev.f1_summary(x.stats)


@query
def min_support_summary(x):
    return rounded(ev.min_support_summary(ev.per_code_stats(x.oof_sparse()), 10))


@query
def support_buckets(x):
    return rounded(ev.support_buckets(ev.per_code_stats(x.oof_sparse())))


@query
def rollup_comparison(x):
    per_rollup = [x._sparse("dev", r) for r in ROLLUPS]
    rows, notes, codes = (
        reduce(DataFrame.unionByName, [getattr(p, part).withColumn("rollup", F.lit(r)) for p, r in zip(per_rollup, ROLLUPS, strict=True)])
        for part in ("rows", "notes", "codes")
    )
    return rounded(ev.rollup_comparison(ev.Sparse(rows, notes, codes, ev.DEFAULT_THRESHOLD)))


@query
def worst_codes(x):
    return ev.worst_codes(x.stats)


@query
def best_codes(x):
    return ev.best_codes(x.stats)


@query
def top_codes_by_support(x):
    return ev.top_codes_by_support(x.stats)


@query
def sample_prediction(x):
    return ev.sample_prediction(x.held_out_sparse.rows, x.notes)


# ------------------------------------------------------------------ profiles


@query
def table_profile(x):
    tables = (("notes_synth", x.notes), ("notes_labels", x.labels))
    profiles = [pf.table_profile(df, name, _nullable(df.schema)) for name, df in tables]
    return profiles[0].unionByName(profiles[1])


@query
def top_conditions(x):
    return pf.top_conditions(x.conditions)


@query
def billable_profile(x):
    return pf.billable_profile(x.conditions, x.billable)


@query
def fanout_profile(x):
    return rounded(pf.fanout_profile(x.labels, x.labels_3char))


@query
def mapping_fanout(x):
    return pf.mapping_fanout(tm.crosswalk(x.concept, x.edges))


@query
def primary_profile(x):
    return pf.primary_profile(x.notes)


@query
def model_freshness(x):
    trained = ds.load_patient_dataset(
        x.notes.where("run_id = 'r000000'"), x.labels, x.split, bucket="dev", min_code_freq=1
    ).info
    return pf.model_freshness(trained, x.dev.info)


# ------------------------------------------------------------------ features


@query
def word_tokens(x):
    unigrams = ft.Block("word", 1, 1)
    return ft.term_counts(x.texts, unigrams)


@query
def word_ngrams(x):
    return ft.document_frequencies(x.texts, ft.WORD).where("df >= 2")


@query
def char_ngrams(x):
    return ft.document_frequencies(x.texts, ft.CHAR).where("df >= 2")


@query
def tfidf_vocab(x):
    return ft.fit_vocabularies(x.texts).select("block", "term", "feature_id", "df", "cf")


@query
def idf_weights(x):
    return rounded(ft.vocabulary(x.texts, ft.WORD).select("term", "df", "idf"))


@query
def tfidf_rows(x):
    return rounded(ft.tfidf(x.texts, ft.vocabulary(x.texts, ft.WORD), ft.WORD))


@query
def feature_union(x):
    vocabularies = materialize(ft.fit_vocabularies(x.texts), "vocabulary")
    rows = ft.feature_rows(x.texts, vocabularies)
    return rounded(
        rows.groupBy("note_id", "block").agg(
            F.count("*").alias("n_features"),
            F.min("feature_id").alias("first_feature"),
            F.max("feature_id").alias("last_feature"),
            F.sum("weight").alias("total_weight"),
            F.sum(F.col("weight") * F.col("weight")).alias("squared_length"),
        )
    )


@query
def class_weights(x):
    n_notes = x.dev.notes.agg(F.count("*")).scalar()
    return rounded(ovr.class_weights(x.dev.labels, x.dev.vocab, n_notes))


# ------------------------------------------------------------------ scoring


@query
def score_long(x):
    return rounded(x.hash_scored(x.dataset("test").notes))


@query
def predict_default(x):
    return pr.predict_default(x.hash_scored(x.dataset("test").notes)).drop("y_proba")


@query
def predict_threshold(x):
    return pr.predict_threshold(x.hash_scored(x.dataset("test").notes, min_proba=0.6), 0.6)


@query
def predict_described(x):
    shown = pr.predict_threshold(x.held_out, 0.5)
    cli = pr.describe(shown, x.dictionary, pr.CLI_DEFAULT_DESCRIPTION).withColumn("surface", F.lit("cli"))
    service = pr.describe(shown, x.dictionary, pr.SERVICE_DEFAULT_DESCRIPTION).withColumn("surface", F.lit("service"))
    return cli.unionByName(service)


@query
def ranked_predictions(x):
    return ev.ranked_predictions(pr.predict_threshold(x.held_out, 0.3))


# ------------------------------------------------------------------ fitting


@query
def fit_ovr(x):
    """The fit over dev with its certificate: class sizes, balanced weights, gradient under its bound."""
    data = x.dev
    model = ovr.fit(data.notes, data.labels, data.vocab)
    vectors = materialize(wf.training_vectors(model, data), "training-vectors")
    proved = cf.certify(vectors, model.coefficients).select("label_code", "is_optimal")
    weights = ovr.class_weights(data.labels, data.vocab, model.info["n_notes"])
    return rounded(weights.join(proved, "label_code", "left"))


def _checked_folds(data):
    """Per fold its sizes, whether each of its notes has each code once, and whether every label converged."""
    done = wf.cross_validation(data, k=5)
    oof = materialize(done.predictions, "oof")
    n_notes, n_codes = (oof.agg(F.count_distinct(c)).scalar() for c in ("note_id", "code"))
    bad = [fold for fold, labels in done.not_converged.items() if labels]
    per_note = oof.groupBy("fold", "note_id").agg(
        F.count("*").alias("n"),
        F.count_distinct("code").alias("n_different"),
        F.sum("y_true").alias("positives"),
        F.bool_and((F.col("y_pred") == (F.col("y_proba") > 0.5).cast("int")) & F.col("y_proba").between(0, 1)).alias("sound"),
    )
    whole = (F.col("n") == n_codes) & (F.col("n_different") == n_codes)
    return per_note.groupBy("fold").agg(
        (n_notes - F.count("*")).alias("n_train"),
        F.count("*").alias("n_val"),
        F.sum("positives").alias("n_positive"),
        F.bool_and(whole).alias("each_code_once"),
        F.bool_and("sound").alias("predictions_sound"),
        (~F.col("fold").isin(bad)).alias("converged"),
    )


def _checked_evaluation(dev, test):
    """Sizes of an evaluation, and whether its probabilities are those recomputed from the coefficients."""
    model = ovr.fit(dev.notes, dev.labels, dev.vocab)
    scored = materialize(wf.evaluate(model, test), "evaluation")
    again = cf.probabilities(wf.training_vectors(model, test), model.coefficients).withColumnRenamed("y_proba", "again")
    joined = scored.join(again, ["note_id", "code"], "left")
    # A label that every dev note has, or none, has a constant instead of a margin.
    differs = F.abs(F.col("y_proba") - F.coalesce("again", F.round("y_proba"))) > 1e-9
    return joined.agg(
        F.count_distinct("note_id").alias("n_notes"),
        F.count_distinct("code").alias("n_codes"),
        F.count("*").alias("n_rows"),
        F.sum("y_true").alias("n_positive"),
        (F.count_if(differs) == 0).alias("probabilities_agree"),
        F.bool_and(F.col("y_pred") == (F.col("y_proba") > 0.5).cast("int")).alias("predictions_sound"),
        F.lit(not model.info["not_converged"]).alias("converged"),
    )


@query
def cross_validate(x):
    return _checked_folds(x.dev)


@query
def evaluate_bucket(x):
    return _checked_evaluation(x.dev, x.dataset("test"))


@query
def encounter_cross_validate(x):
    return _checked_folds(x.encounter_dataset("dev"))


@query
def encounter_evaluate(x):
    return _checked_evaluation(x.encounter_dataset("dev"), x.encounter_dataset("test"))


# ------------------------------------------------------------------ storage


@query
def csv_landing(x):
    """Conditions written as CSV and landed again."""
    path = f"{scratch_path(x.spark, 'landing')}/conditions.csv"
    x.conditions.write.csv(path, header=True, escape='"')
    landed = ld.read_records_csv(x.spark, path, ld.CONDITIONS_SCHEMA, multi_line=False)
    return text_dates(landed).select("PATIENT", "ENCOUNTER", "START", "STOP", "CODE", "DESCRIPTION")


@query
def csv_quoted_lines(x):
    """Conditions whose descriptions hold line breaks, quotes and commas, written as CSV and landed again."""
    path = f"{scratch_path(x.spark, 'landing')}/conditions.csv"
    broken = F.concat(F.regexp_replace("DESCRIPTION", " ", "\n"), F.lit('", "x"'))
    x.conditions.withColumn("DESCRIPTION", broken).write.csv(path, header=True, escape='"')
    landed = ld.read_records_csv(x.spark, path, ld.CONDITIONS_SCHEMA)
    return text_dates(landed).select("PATIENT", "ENCOUNTER", "START", "STOP", "CODE", "DESCRIPTION")


@query
def tsv_vocabulary(x):
    """Concepts written as unquoted TSV and read again."""
    path = scratch_path(x.spark, "vocabulary")
    x.concept.write.csv(path, header=True, sep="\t", quote="")
    return ld.read_vocabulary_tsv(x.spark, path, ld.CONCEPT_COLUMNS)


def _store(x):
    store = NoteStore(x.spark, scratch_path(x.spark, "store"))
    store.ensure_tables()
    store.ensure_tables()
    for half in (0, 1):
        part = F.pmod(F.xxhash64("note_id"), F.lit(2)) == half
        store.append(x.notes.where(part), x.labels.where(part))
    return store


@query
def stored_notes(x):
    """Notes appended in two runs, read from the store."""
    return _store(x).notes().select("note_id", "run_id", "patient_id", "strategy", "note_text")


@query
def stored_after_failure(x):
    """Notes and label counts of the first append, after a second one failed with its labels already written."""
    store = NoteStore(x.spark, scratch_path(x.spark, "store"))
    store.ensure_tables()
    first = F.substring(F.md5("note_id"), 1, 1) < "8"
    store.append(x.notes.where(first), x.labels.where(first))
    broken = x.notes.where(~first).withColumn("note_text", F.lit(None).cast("string"))
    try:
        store.append(broken, x.labels.where(~first))
    except PySparkException:
        pass
    else:
        raise AssertionError("a note without text was stored")
    n_labels = store.labels().groupBy("note_id").agg(F.count("*").alias("n_labels"))
    return store.notes().join(n_labels, "note_id", "left").select("note_id", "run_id", F.coalesce("n_labels", F.lit(0)).alias("n_labels"))


@query
def stored_labels(x):
    return _store(x).labels().select("note_id", "icd10_code", "is_primary")


@query
def notes_backup(x):
    """Notes written as JSON lines and read again."""
    path = scratch_path(x.spark, "backup")
    write_backup(x.notes, path)
    return read_backup(x.spark, path).select("note_id", "run_id", "strategy", "primary_code", "input_tokens", "note_text")


@query
def stored_split(x):
    path = scratch_path(x.spark, "stored-split")
    rs.save_split(x.split, path, "pairs")
    return rs.load_split(x.spark, path, "pairs").select("key", "bucket")


# ------------------------------------------------------------------ streaming


@query
def stream_latest(x):
    feed = scratch_path(x.spark, "feed")
    rows = x.notes.select("note_id", "patient_id", "strategy", "generated_at", "note_text")
    rows.write.json(feed)
    out = scratch_path(x.spark, "latest")
    st_latest.follow_latest(x.spark, feed, rows.schema, out).awaitTermination()
    return st_latest.read_latest(x.spark, out).select("patient_id", "strategy", "note_id")


def _scored_stream(x):
    """Folder of what a stream over all documents wrote."""
    vocabularies, coefficients = x.hashed_model
    model = ovr.Model(vocabularies, coefficients, [], {})
    out = scratch_path(x.spark, "scored")
    source = f"{x.sf_dir}/documents.parquet*"
    columns = x.table("documents").schema
    arriving = x.spark.readStream.schema(columns).parquet(source).select(
        F.col("doc_id").cast("string").alias("note_id"), F.col("text").alias("note_text")
    )
    st_scoring.score_stream(arriving, model, out, threshold=0.6, model_name="hashed", dictionary=lambda _: x.dictionary).awaitTermination()
    return out


@query
def stream_score(x):
    return st_scoring.read_predictions(x.spark, _scored_stream(x))


@query
def stream_responses(x):
    """Whole responses; their predictions in order as code:confidence:description, set apart by bars."""
    shown = F.transform(
        "predictions",
        lambda p: F.concat_ws(":", p["code"], p["confidence"].cast("decimal(5,4)").cast("string"), p["description"]),
    )
    return st_scoring.read_responses(x.spark, _scored_stream(x)).select(
        "note_id", "model", "n_codes_evaluated", "note_length", F.array_join(shown, "|").alias("predictions")
    )


@query
def stream_rejects(x):
    return st_scoring.read_rejects(x.spark, _scored_stream(x))
