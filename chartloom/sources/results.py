"""Stored splits, predictions, thresholds, reports, models and the code dictionary."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.keys import pair_from_note_id
from chartloom.operators.evaluation import DEFAULT_THRESHOLD
from chartloom.operators.ovr import COEFFICIENT_SCHEMA, Model
from chartloom.operators.splits import assert_disjoint
from chartloom.sources import commits
from chartloom.sources.paths import exists, file_system

KEY_TYPES = ("pairs", "encounter_ids")
# Model names and the folders their bundles live in.
MODEL_BUNDLES = {"encounter": "baseline_encounter", "patient": "baseline_3char"}
VOCABULARY_SCHEMA = "block string, term string, feature_id int, df bigint, cf bigint, idf double"
OOF_SCHEMA = "note_id string, fold int, code string, y_true int, y_proba double, y_pred int"
DICTIONARY_SCHEMA = "code_3char string, description string"
SPLIT_FACTS_SCHEMA = "key_type string, seed long, test_fraction double, rollup string"


# ---------------------------------------------------------------- splits


def save_split(
    split: DataFrame,
    path: str,
    key_type: str,
    *,
    seed: int | None = None,
    test_fraction: float | None = None,
    rollup: str | None = None,
) -> None:
    """Store (key, bucket) marked with what its keys are, and beside it how the split was made."""
    if key_type not in KEY_TYPES:
        raise ValueError(f"unknown key type {key_type!r}")
    split.select("key", "bucket", F.lit(key_type).alias("key_type")).write.mode("overwrite").parquet(path)
    facts = split.sparkSession.createDataFrame([(key_type, seed, test_fraction, rollup)], SPLIT_FACTS_SCHEMA)
    facts.write.mode("overwrite").parquet(f"{path.rstrip('/')}.facts")


def load_split_facts(spark: SparkSession, path: str) -> DataFrame:
    """One row: key type, seed, test fraction and rollup of a stored split; unknown ones are null."""
    return spark.read.schema(SPLIT_FACTS_SCHEMA).parquet(f"{path.rstrip('/')}.facts")


def migrate_legacy_split(legacy: DataFrame) -> DataFrame:
    """(key, bucket) of a split of old note ids: each id's patient and strategy is the key.

    Several ids of one pair give one row; a pair that the old split had in both buckets is
    an error, and ids of another format are left out.
    """
    keyed = legacy.select(pair_from_note_id(F.col("note_id")).alias("key"), "bucket")
    return assert_disjoint(keyed.where("key is not null").distinct())


def load_split(spark: SparkSession, path: str, key_type: str) -> DataFrame:
    """A stored split; fails if it is missing or keyed on something else."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no split at {path}")
    stored = spark.read.schema("key string, bucket string, key_type string").parquet(path)
    other = stored.where(F.col("key_type") != key_type).select("key_type").first()
    if other:
        raise ValueError(f"split at {path} is keyed on {other.key_type}, not {key_type}")
    return stored.select("key", "bucket")


# ---------------------------------------------------------------- evaluation results


def save_oof(oof: DataFrame, path: str) -> None:
    oof.write.mode("overwrite").parquet(path)


def load_oof(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"no out-of-fold predictions at {path}")
    return spark.read.schema(OOF_SCHEMA).parquet(path)


def save_thresholds(sweep: DataFrame, best: DataFrame, summary: DataFrame, path: str, rollup: str) -> None:
    """The sweep as a table, and one row with the best points and the fold summary."""
    sweep.write.mode("overwrite").parquet(f"{path}/sweep")
    points = ["threshold", "micro_precision", "micro_recall", "micro_f1", "macro_precision", "macro_recall", "macro_f1"]
    entry = F.struct(*points)
    chosen = best.agg(
        F.max(F.when(F.col("metric") == "micro_f1", entry)).alias("best_for_micro_f1"),
        F.max(F.when(F.col("metric") == "macro_f1", entry)).alias("best_for_macro_f1"),
    )
    payload = chosen.withColumns({"rollup": F.lit(rollup), "default_threshold": F.lit(DEFAULT_THRESHOLD)})
    for name in ("mean_micro_f1", "std_micro_f1", "mean_macro_f1", "std_macro_f1"):
        payload = payload.withColumn(f"cv_{name}", summary.select(name).scalar())
    payload.write.mode("overwrite").json(f"{path}/best")


def save_per_code_stats(stats: DataFrame, path: str) -> None:
    stats.orderBy("f1", "code").write.mode("overwrite").csv(path, header=True)


# ---------------------------------------------------------------- models


def save_model(model: Model, models_dir: str, name: str) -> str:
    """Store a model's tables under ``models_dir/name`` as its newest version.

    The tables go to a new folder and a pointer is switched when all of them are whole.
    Earlier versions stay as they are, so a model may be saved over the one it was read from.
    """
    path = f"{models_dir.rstrip('/')}/{name}"
    spark = model.coefficients.sparkSession
    folder = commits.fresh_name()
    model.vocabularies.write.parquet(f"{path}/{folder}/vocabularies")
    model.coefficients.write.parquet(f"{path}/{folder}/coefficients")
    info = spark.createDataFrame([(json.dumps(model.info), model.labels)], "info string, labels array<string>")
    info.write.parquet(f"{path}/{folder}/info")
    commits.publish(spark, path, lambda state: {"folder": folder})
    return path


def load_model(spark: SparkSession, models_dir: str, name: str) -> Model:
    path = f"{models_dir.rstrip('/')}/{name}"
    version, state = commits.latest(spark, path)
    if not version:
        raise FileNotFoundError(f"no model at {path}")
    path = f"{path}/{state['folder']}"
    row = spark.read.parquet(f"{path}/info").first()
    return Model(
        spark.read.schema(VOCABULARY_SCHEMA).parquet(f"{path}/vocabularies"),
        spark.read.schema(COEFFICIENT_SCHEMA).parquet(f"{path}/coefficients"),
        list(row.labels),
        json.loads(row.info),
    )


def load_named_model(spark: SparkSession, models_dir: str, model: str = "encounter") -> Model:
    """The bundle behind a public model name."""
    if model not in MODEL_BUNDLES:
        raise ValueError(f"model must be one of {', '.join(MODEL_BUNDLES)}")
    return load_model(spark, models_dir, MODEL_BUNDLES[model])


def available_models(spark: SparkSession, models_dir: str) -> list[str]:
    """Public names with a whole stored model."""
    files, path = file_system(spark, models_dir)
    present = {s.getPath().getName() for s in files.listStatus(path)} if files.exists(path) else set()
    whole = {f for f in present & set(MODEL_BUNDLES.values()) if commits.latest(spark, f"{models_dir.rstrip('/')}/{f}")[0]}
    return sorted((n for n, folder in MODEL_BUNDLES.items() if folder in whole), key=list(MODEL_BUNDLES).index)


# ---------------------------------------------------------------- code dictionary


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Code descriptions; a missing file is an empty dictionary."""
    if not exists(spark, path):
        return spark.createDataFrame([], DICTIONARY_SCHEMA)
    return spark.read.csv(path, header=True, schema=DICTIONARY_SCHEMA, multiLine=True, escape='"')
