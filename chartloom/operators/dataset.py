"""From notes, labels and a split to a modelling dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.keys import PATIENT_STRATEGIES, pair_key
from chartloom.operators.labels import labels_per_note, rollup_labels
from chartloom.operators.notes import encounter_notes, latest_notes
from chartloom.operators.ranking import first_by
from chartloom.session import materialize

MIN_CODE_FREQ = 3
BUCKETS = {"dev": ("dev",), "test": ("test",), "all": ("dev", "test")}


@dataclass
class Dataset:
    """Notes of a bucket, their kept labels, the label vocabulary, and a one-row description."""

    notes: DataFrame  # note_id, note_text
    labels: DataFrame  # note_id, label_code (distinct, kept codes only)
    vocab: DataFrame  # label_code
    info: DataFrame


def _check_bucket(bucket: str) -> None:
    if bucket not in BUCKETS:
        raise ValueError(f"unknown bucket {bucket!r}")


def bucket_notes(keyed_notes: DataFrame, split: DataFrame, bucket: str) -> DataFrame:
    """Notes whose ``key`` the split puts in the bucket ("dev", "test" or "all")."""
    _check_bucket(bucket)
    wanted = split.where(F.col("bucket").isin(*BUCKETS[bucket])).select("key", "bucket")
    return keyed_notes.join(wanted, "key")


def code_counts(labels: DataFrame, min_code_freq: int = MIN_CODE_FREQ) -> DataFrame:
    """Label rows per code and whether the code is frequent enough to keep."""
    return (
        labels.groupBy("label_code")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("kept", F.col("n_rows") >= min_code_freq)
    )


def label_vocab(dev_labels: DataFrame, min_code_freq: int = MIN_CODE_FREQ) -> DataFrame:
    """Codes with at least ``min_code_freq`` label rows in the dev bucket."""
    return code_counts(dev_labels, min_code_freq).where("kept").select("label_code", "n_rows")


def keep_vocab(labels: DataFrame, vocab: DataFrame) -> DataFrame:
    """Distinct (note, code) rows whose code is in the vocabulary."""
    return labels.join(vocab.select("label_code"), "label_code", "left_semi").select("note_id", "label_code").distinct()


def nonempty_notes(notes: DataFrame, kept_labels: DataFrame) -> DataFrame:
    return notes.join(kept_labels.select("note_id"), "note_id", "left_semi")


def _codes_array(vocab: DataFrame):
    """Sorted vocabulary as one array value; its size is the label vocabulary's, not the data's."""
    return vocab.agg(F.sort_array(F.collect_list("label_code"))).scalar()


def binarize(notes: DataFrame, labels: DataFrame, vocab: DataFrame) -> DataFrame:
    """Dense (note_id, code, y_true) over every note and vocabulary code.

    Labels outside the vocabulary vanish and codes no note has become all zero, so the
    same call re-binarizes a bucket against a trained model's vocabulary. The code list
    reaches each task as one scalar value, so no cross join and no shuffle of the dense
    rows takes place.
    """
    grouped = labels_per_note(notes.select("note_id"), labels)
    dense = grouped.withColumn("_codes", _codes_array(vocab)).select(
        "note_id", "label_codes", F.explode("_codes").alias("code")
    )
    return dense.select(
        "note_id", "code", F.expr("array_contains(label_codes, code)").cast("int").alias("y_true")
    )


def dataset_info(
    wanted: DataFrame, kept_labels: DataFrame, counts: DataFrame, rollup: str, bucket: str, min_code_freq: int
) -> DataFrame:
    """One row: notes used and dropped, codes kept and dropped, mean labels per note.

    ``wanted`` are all notes of the bucket, ``kept_labels`` their distinct kept labels and
    ``counts`` the dev code counts.
    """
    per_note = kept_labels.groupBy("note_id").agg(F.count("*").alias("n"))
    notes = wanted.select("note_id").join(per_note, "note_id", "left").agg(
        F.count("n").alias("n_notes"),
        F.count_if(F.col("n").isNull()).alias("n_notes_dropped_empty"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_labels_per_note"),
    )
    return notes.select(
        F.lit(rollup).alias("rollup"),
        F.lit(bucket).alias("bucket"),
        "n_notes",
        "n_notes_dropped_empty",
        counts.agg(F.count_if("kept")).scalar().alias("n_codes_kept"),
        counts.agg(F.count_if(~F.col("kept"))).scalar().alias("n_codes_dropped_rare"),
        F.lit(min_code_freq).alias("min_code_freq"),
        "avg_labels_per_note",
    )


def dataset_infos(
    current: DataFrame,
    labels: DataFrame,
    split: DataFrame,
    *,
    rollups: Sequence[str],
    buckets: Sequence[str] = ("dev", "test"),
    min_code_freq: int = MIN_CODE_FREQ,
) -> DataFrame:
    """``dataset_info`` of every (rollup, bucket), without a dataset for each.

    ``current``: (note_id, key) of the usable notes. Two narrow tables are stored, whatever the
    number of rollups and buckets: the notes' buckets, and one count per (rollup, note, code).
    """
    for bucket in buckets:
        _check_bucket(bucket)
    members = materialize(bucket_notes(current, split, "all").select("note_id", "bucket"), "members")
    wanted = labels.join(members, "note_id", "left_semi")
    rolled = [rollup_labels(wanted, r).select(F.lit(r).alias("rollup"), "note_id", "label_code") for r in rollups]
    counted = reduce(DataFrame.unionByName, rolled).groupBy("rollup", "note_id", "label_code")
    cells = materialize(counted.agg(F.count("*").alias("n_rows")).join(members, "note_id"), "label-cells")
    counts = (
        cells.where("bucket = 'dev'")
        .groupBy("rollup", "label_code")
        .agg((F.sum("n_rows") >= min_code_freq).alias("kept"))
    )
    per_note = (
        cells.join(counts.where("kept"), ["rollup", "label_code"], "left_semi")
        .groupBy("rollup", "bucket", "note_id")
        .agg(F.count("*").alias("n"))
    )

    def named(rows: DataFrame) -> DataFrame:
        """Each row once for every asked bucket that its own one belongs to."""
        names = [F.when(F.col("bucket").isin(*BUCKETS[b]), b) for b in buckets]
        return rows.withColumn("bucket", F.explode(F.array_compact(F.array(*names))))

    used = named(per_note.groupBy("rollup", "bucket").agg(F.count("*").alias("n_notes"), F.sum("n").alias("n_labels")))
    used = used.groupBy("rollup", "bucket").agg(F.sum("n_notes").alias("n_notes"), F.sum("n_labels").alias("n_labels"))
    sizes = named(members.groupBy("bucket").agg(F.count("*").alias("n_members"))).groupBy("bucket")
    codes = counts.groupBy("rollup").agg(
        F.count_if("kept").alias("n_codes_kept"), F.count_if(~F.col("kept")).alias("n_codes_dropped_rare")
    )
    asked = [F.struct(F.lit(r).alias("rollup"), F.lit(b).alias("bucket")) for r in rollups for b in buckets]
    spark = current.sparkSession
    n_notes = F.coalesce("n_notes", F.lit(0).cast("long"))
    return (
        spark.range(1)
        .select(F.inline(F.array(*asked)))
        .join(used, ["rollup", "bucket"], "left")
        .join(sizes.agg(F.sum("n_members").alias("n_members")), "bucket", "left")
        .join(codes, "rollup", "left")
        .select(
            "rollup",
            "bucket",
            n_notes.alias("n_notes"),
            (F.coalesce("n_members", F.lit(0).cast("long")) - n_notes).alias("n_notes_dropped_empty"),
            F.coalesce("n_codes_kept", F.lit(0).cast("long")).alias("n_codes_kept"),
            F.coalesce("n_codes_dropped_rare", F.lit(0).cast("long")).alias("n_codes_dropped_rare"),
            F.lit(min_code_freq).alias("min_code_freq"),
            F.coalesce(F.col("n_labels") / F.col("n_notes"), F.lit(0.0)).alias("avg_labels_per_note"),
        )
    )


def _assemble(current, notes, labels, split, rollup, bucket, min_code_freq) -> Dataset:
    """``current``: (note_id, key) of the usable notes. ``labels``: raw label rows.

    Membership and labels are narrow and used many times, so they are written once; note
    texts are read a single time, by the dataset's consumer.
    """
    _check_bucket(bucket)
    members = materialize(bucket_notes(current, split, "all").select("note_id", "bucket"), "members")
    found = materialize(
        rollup_labels(labels, rollup).join(members, "note_id").select("note_id", "label_code", "bucket"), "found-labels"
    )
    counts = materialize(code_counts(found.where("bucket = 'dev'"), min_code_freq), "code-counts")
    vocab = counts.where("kept").select("label_code")
    in_bucket = F.col("bucket").isin(*BUCKETS[bucket])
    kept = materialize(keep_vocab(found.where(in_bucket), vocab), "kept-labels")
    return Dataset(
        notes=nonempty_notes(notes.select("note_id", "note_text"), kept),
        labels=kept,
        vocab=vocab,
        info=dataset_info(members.where(in_bucket), kept, counts, rollup, bucket, min_code_freq),
    )


def load_patient_dataset(
    notes: DataFrame,
    labels: DataFrame,
    split: DataFrame,
    *,
    rollup: str = "3char",
    bucket: str = "dev",
    min_code_freq: int = MIN_CODE_FREQ,
    strategies: tuple[str, ...] | None = PATIENT_STRATEGIES,
) -> Dataset:
    """Latest note per (patient, strategy) in the bucket, with labels frequent in dev."""
    current = latest_notes(notes, strategies).select(
        "note_id", pair_key(F.col("patient_id"), F.col("strategy")).alias("key")
    )
    return _assemble(current, notes, labels, split, rollup, bucket, min_code_freq)


def load_encounter_dataset(
    notes: DataFrame,
    labels: DataFrame,
    split: DataFrame,
    *,
    rollup: str = "3char",
    bucket: str = "dev",
    min_code_freq: int = MIN_CODE_FREQ,
    latest_only: bool = False,
) -> Dataset:
    """Encounter notes in the bucket; every version counts unless ``latest_only``."""
    current = encounter_notes(notes)
    if latest_only:
        current = first_by(current, ["encounter_id"], [F.desc("generated_at"), F.desc("note_id")])
    current = current.select("note_id", F.col("encounter_id").alias("key"))
    return _assemble(current, notes, labels, split, rollup, bucket, min_code_freq)
