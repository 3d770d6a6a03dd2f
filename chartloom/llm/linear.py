"""What the trained text classifiers share: labelled samples, sparse rows, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.tokens import slices
from chartloom.session import ship_package

FOLDS = 5
# A fit reads at most so many labelled rows, the first by a hash of their id; every row is scored.
MAX_FIT_ROWS = 20_000
# Bytes of text that a task turns into Python strings at once, whatever the batch; a longer text is on its own.
SLICE_BYTES = 1 << 20
HASH_BITS = 18
SIZE = 1 << HASH_BITS


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def bucket(feature: str) -> int:
    return crc32(feature.encode("utf-8", "surrogatepass")) & (SIZE - 1)


def training_texts(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """(text, y) of at most ``max_rows`` documents whose label may be learned from.

    Labels that are null or contradict each other for one id are left out, as are rows
    without an id; a repeated document counts once.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("_top"))
        .where("y = _top")
        .select("doc_id", F.col("y").cast("int").alias("y"))
    )
    present = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    # At most ``max_rows`` rows of two numbers: small enough to send to every task.
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).select("doc_id", "text", "y")


def fit_rows(texts: DataFrame, features: Callable[[str], np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature rows and labels of a bounded sample, in order of doc_id; features are made in the tasks."""
    ship_package(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1, SLICE_BYTES):
                found = [features(t).tobytes() for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(found, pa.binary()), rows.column(2)], ["doc_id", "features", "y"]
                )

    sample = texts.select(F.col("doc_id").cast("long"), "text", "y")
    table = sample.mapInArrow(run, "doc_id long, features binary, y int").toArrow().sort_by("doc_id")
    rows = [np.frombuffer(b, np.int32) for b in table.column("features").to_pylist()]
    return rows, table.column("y").to_numpy().astype(np.int64)


def score(docs: DataFrame, scorer: Callable[[str], float]) -> DataFrame:
    """(doc_id, score) for every row of ``docs``; null texts are scored as empty ones."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1, SLICE_BYTES):
                scores = [scorer(t or "") for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, scorer: Callable[[str], float], wanted: Callable[[float], bool]) -> DataFrame:
    """The rows of ``docs`` whose text (null: empty) has a score that is wanted, all columns as they are."""
    ship_package(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from kept_rows(batch, at, scorer, wanted)

    return docs.mapInArrow(run, docs.schema)


def kept_rows(
    batch: pa.RecordBatch, at: int, scorer: Callable[[str], float], wanted: Callable[[float], bool]
) -> Iterator[pa.RecordBatch]:
    """The rows of a batch whose text in column ``at`` is wanted, slice by slice."""
    for rows in slices(batch, at, SLICE_BYTES):
        use = [wanted(scorer(t or "")) for t in rows.column(at).to_pylist()]
        yield rows.filter(pa.array(use, pa.bool_()))


def report(scored: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score and the decision at ``threshold``."""
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def sigmoid(z: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def calibration(margins: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and intercept that turn margins into probabilities (logistic fit by Newton steps, smoothed targets)."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0))
    w = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(rounds):
        p = sigmoid(x @ w)
        h = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-6 * w)
        w = w + np.clip(step, -2.0, 2.0)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])
