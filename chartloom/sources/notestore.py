"""The note and label tables, and the JSON-lines backup of notes."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.profiling import table_profile
from chartloom.sources import commits

NOTES_SCHEMA = (
    "note_id string NOT NULL, run_id string NOT NULL, patient_id string NOT NULL, strategy string NOT NULL, "
    "prompt_version string NOT NULL, model string NOT NULL, generated_at timestamp NOT NULL, note_text string NOT NULL, "
    "labels array<string>, primary_code string, encounter_id string, input_tokens bigint, output_tokens bigint, "
    "finish_reason string"
)
LABELS_SCHEMA = "note_id string NOT NULL, icd10_code string NOT NULL, icd10_description string, is_primary boolean NOT NULL"
DAY = "generated_date"

logger = logging.getLogger(__name__)


class NoteStore:
    """Append-only notes (partitioned by day of generation) and labels under one folder.

    Every append writes a folder of its own in each table; one pointer then makes both
    visible together. An append that fails half-way changes nothing a reader sees.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.notes_path = f"{self.root}/notes_synth"
        self.labels_path = f"{self.root}/notes_labels"

    def ensure_tables(self) -> None:
        """Create both tables where they are missing; calling again changes nothing."""
        if not commits.latest(self.spark, self.root)[0]:
            commits.publish(self.spark, self.root, lambda state: {"notes": [], "labels": [], **state})

    def append(self, notes: DataFrame, labels: DataFrame) -> None:
        """Add a run's rows to both tables, or to none if either cannot be written."""
        folder = f"run={commits.fresh_name()}"
        written = {
            "labels": self._append(labels, LABELS_SCHEMA, f"{self.labels_path}/{folder}", None),
            "notes": self._append(notes, NOTES_SCHEMA, f"{self.notes_path}/{folder}", DAY),
        }
        added = {table: [folder] for table, any_rows in written.items() if any_rows}
        if added:
            commits.publish(
                self.spark, self.root, lambda state: {t: state.get(t, []) + added.get(t, []) for t in written}
            )

    def _append(self, rows: DataFrame, schema: str, path: str, day: str | None) -> bool:
        if rows.isEmpty():
            logger.warning("no rows to load for %s", path)
            return False
        declared = self.spark.createDataFrame([], schema).schema
        absent = [f.name for f in declared.fields if f.name not in rows.columns and not f.nullable]
        if absent:
            raise ValueError(f"missing columns for {path}: {', '.join(absent)}")
        columns = []
        for field in declared.fields:
            value = F.col(field.name) if field.name in rows.columns else F.lit(None)
            value = value.cast(field.dataType)
            if not field.nullable:
                message = F.lit(f"{field.name} must not be null")
                value = F.when(value.isNull(), F.raise_error(message)).otherwise(value)
            columns.append(value.alias(field.name))
        typed = rows.select(*columns)
        if day:
            typed.withColumn(day, F.to_date("generated_at")).write.partitionBy(day).parquet(path)
        else:
            typed.write.parquet(path)
        return True

    def _read(self, table: str, path: str, schema: str) -> DataFrame:
        """The rows of every committed run."""
        version, state = commits.latest(self.spark, self.root)
        if not version:
            raise FileNotFoundError(f"no note store at {self.root}")
        if not state[table]:
            return self.spark.createDataFrame([], schema)
        runs = [f"{path}/{folder}" for folder in state[table]]
        return self.spark.read.schema(schema).option("basePath", path).parquet(*runs).drop("run")

    def notes(self) -> DataFrame:
        return self._read("notes", self.notes_path, f"{NOTES_SCHEMA}, {DAY} date")

    def labels(self) -> DataFrame:
        """Labels of visible notes."""
        stored = self._read("labels", self.labels_path, LABELS_SCHEMA)
        return stored.join(self.notes().select("note_id"), "note_id", "left_semi")

    def register_views(self) -> None:
        """Named views over the stored tables and their clean label rollups."""
        from chartloom.operators.labels import rollup_labels

        self.notes().createOrReplaceTempView("notes_synth")
        self.labels().createOrReplaceTempView("notes_labels")
        for rollup in ("3char", "chapter"):
            rollup_labels(self.labels(), rollup).createOrReplaceTempView(f"notes_labels_clean_{rollup}")

    def describe(self) -> DataFrame:
        """Row count, columns, types and modes of both tables."""
        shaped = []
        for name, table, path, schema in (
            ("notes_synth", "notes", self.notes_path, NOTES_SCHEMA),
            ("notes_labels", "labels", self.labels_path, LABELS_SCHEMA),
        ):
            declared = self.spark.createDataFrame([], schema).schema
            shaped.append(table_profile(self._read(table, path, schema), name, declared))
        return shaped[0].unionByName(shaped[1])


def write_backup(notes: DataFrame, path: str) -> None:
    """Notes as JSON lines, one object per note."""
    notes.write.mode("append").json(path)


def read_backup(spark: SparkSession, path: str) -> DataFrame:
    """Notes of a backup; fields an older backup lacks are null."""
    return spark.read.schema(NOTES_SCHEMA).json(path)
