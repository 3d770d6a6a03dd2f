"""Scoring notes as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartloom.operators.evaluation import DEFAULT_THRESHOLD
from chartloom.operators.notes import MIN_NOTE_CHARS
from chartloom.operators.ovr import Model, score_notes
from chartloom.operators.predict import SERVICE_DEFAULT_DESCRIPTION, describe, predict_threshold, responses

PREDICTION_SCHEMA = "note_id string, code string, confidence double"
RESPONSE_SCHEMA = (
    "note_id string, predictions array<struct<code:string,confidence:double,description:string>>, model string, "
    "n_codes_evaluated int, note_length int"
)
REJECT_SCHEMA = "note_id string, note_length int, reason string"


def score_stream(
    arriving: DataFrame,
    model: Model,
    out: str,
    *,
    threshold: float = DEFAULT_THRESHOLD,
    available_now: bool = True,
    model_name: str = "",
    dictionary: Callable[[SparkSession], DataFrame] | None = None,
) -> StreamingQuery:
    """Write thresholded predictions and one response for each arriving (note_id, note_text).

    Notes are independent, so a micro-batch is scored like a batch; its directories are
    overwritten when the batch is replayed, which keeps the output exactly-once. Notes the
    service would refuse (no text, or fewer than MIN_NOTE_CHARS characters) go to the
    rejects with the reason.

    ``dictionary`` gives (code_3char, description), one row per code. It is called for every
    micro-batch, so a stream that runs for months answers with the descriptions of the day;
    codes it lacks, and all codes without it, have the empty description.
    """
    n_codes = model.coefficients.count()

    def store(batch: DataFrame, batch_id: int) -> None:
        notes = batch.select("note_id", "note_text", F.length("note_text").alias("note_length")).persist()
        long_enough = F.coalesce(F.col("note_length") >= MIN_NOTE_CHARS, F.lit(False))
        reason = F.when(F.col("note_length").isNull(), "no text").otherwise("too short")
        rejects = notes.where(~long_enough).select("note_id", "note_length", reason.alias("reason"))
        rejects.write.mode("overwrite").parquet(f"{out}/rejects/batch={batch_id}")
        valid = notes.where(long_enough).select("note_id", "note_text")
        predictions = predict_threshold(score_notes(valid, model, min_proba=threshold), threshold)
        path = f"{out}/predictions/batch={batch_id}"
        predictions.write.mode("overwrite").parquet(path)
        stored = batch.sparkSession.read.schema(PREDICTION_SCHEMA).parquet(path)
        if dictionary is None:
            described = stored.withColumn("description", F.lit(SERVICE_DEFAULT_DESCRIPTION))
        else:
            described = describe(stored, dictionary(batch.sparkSession), SERVICE_DEFAULT_DESCRIPTION)
        answers = responses(described, valid, model_name, n_codes)
        answers.write.mode("overwrite").parquet(f"{out}/responses/batch={batch_id}")
        notes.unpersist()

    writer = arriving.writeStream.option("checkpointLocation", f"{out}/checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(store).start()


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        stored = spark.read.schema(schema).parquet(path)
        return stored.drop("batch")
    except AnalysisException:  # nothing has arrived yet
        return spark.createDataFrame([], schema)


def read_predictions(spark: SparkSession, out: str) -> DataFrame:
    """Everything predicted so far."""
    return _read(spark, f"{out}/predictions", PREDICTION_SCHEMA)


def read_responses(spark: SparkSession, out: str) -> DataFrame:
    """One response per accepted note: ranked predictions, model, codes evaluated, note length."""
    return _read(spark, f"{out}/responses", RESPONSE_SCHEMA)


def read_rejects(spark: SparkSession, out: str) -> DataFrame:
    """Notes that were not scored, and why."""
    return _read(spark, f"{out}/rejects", REJECT_SCHEMA)
