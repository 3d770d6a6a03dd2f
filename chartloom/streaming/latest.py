"""Following an appended feed of notes and keeping the latest of each pair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chartloom.operators.notes import latest_notes
from chartloom.sources import commits
from chartloom.sources.paths import file_system

PAIR = ["patient_id", "strategy"]
STATE_SCHEMA = "patient_id string, strategy string, generated_at timestamp, note_id string"
COMPACT_EVERY = 20


def follow_latest(
    spark: SparkSession, feed: str, schema: T.StructType, out: str, *, available_now: bool = True, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Keep, for each (patient, strategy), the newest note of a JSON-lines feed.

    The running maximum per pair lives in the state store and is combined on the map
    side, so one busy pair does not load one task. Only its time and id are state, not
    the text. Each micro-batch writes the pairs that changed under its own batch
    directory, overwriting it when the batch is replayed. After ``compact_every`` batches
    they are merged with the last snapshot into a new one, so a reader takes one snapshot
    and fewer batches than that, however long the stream has run. Merged batches stay for
    readers that opened them.
    """
    newest = (
        spark.readStream.schema(schema)
        .json(feed)
        .groupBy(*PAIR)
        .agg(F.max(F.struct("generated_at", "note_id")).alias("newest"))
        .select(*PAIR, "newest.generated_at", "newest.note_id")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/changes/batch={batch_id}")
        merged = commits.latest(spark, out)[1].get("through", -1)
        if batch_id - merged >= compact_every:
            folder = commits.fresh_name()
            read_latest(spark, out).write.parquet(f"{out}/snapshots/{folder}")
            commits.publish(spark, out, lambda state: {"folder": folder, "through": batch_id})

    writer = newest.writeStream.outputMode("update").option("checkpointLocation", f"{out}/checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(store).start()


def state_folders(spark: SparkSession, out: str) -> list[str]:
    """What a reader takes: the newest snapshot, if any, and the batches it does not hold yet."""
    state = commits.latest(spark, out)[1]
    system, changes = file_system(spark, f"{out}/changes")
    stored = [s.getPath().getName() for s in system.listStatus(changes)] if system.exists(changes) else []
    batches = sorted(int(name.removeprefix("batch=")) for name in stored if name.startswith("batch="))
    later = [f"{out}/changes/batch={b}" for b in batches if b > state.get("through", -1)]
    return ([f"{out}/snapshots/{state['folder']}"] if state else []) + later


def read_latest(spark: SparkSession, out: str) -> DataFrame:
    """The current latest note of each pair."""
    folders = state_folders(spark, out)
    if not folders:  # nothing has arrived yet
        return spark.createDataFrame([], STATE_SCHEMA)
    parts = [spark.read.schema(STATE_SCHEMA).parquet(folder) for folder in folders]
    return latest_notes(reduce(DataFrame.unionByName, parts))
