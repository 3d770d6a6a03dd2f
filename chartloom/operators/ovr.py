"""One-vs-rest logistic regression fitted for all labels at once.

Per label the objective is  ||w||^2 / 2 + C * sum_i s_i * log(1 + exp(-y_i * w.x_i))
with balanced class weights s and the intercept as one more penalised feature. It is
strictly convex, so any solver reaches the same weights.

Each iteration is one Spark pass over packed feature blocks: tasks return the loss and
gradient of every label for their rows, partial sums are combined in two shuffled
levels, and only a model-sized total reaches the driver, which takes the L-BFGS step.
Two passes before find the few directions that most of the rows' squares lie in; flattened along them, a fit
takes about a third of the passes.
Labels are independent, so a model too large for one pass is fitted in label groups.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.features import BLOCKS, block_offsets, feature_vectors, fit_vocabularies, map_vectors
from chartloom.operators.labels import labels_per_note
from chartloom.session import materialize, scratch_path, ship_package

MAX_ITERATIONS = 2000
TOLERANCE = 1e-4
# The objective is 1-strongly convex, so a gradient this small puts the weights within the
# same distance of the optimum, and probabilities within a quarter of it per unit of length.
GRADIENT_FLOOR = 1e-3
C = 1.0
# Labels x features kept on the driver and broadcast per pass; beyond it labels are grouped.
MAX_GROUP_ENTRIES = 4_000_000
# Few enough that a pack, made dense over the columns it touches, stays in cache.
ROWS_PER_PACK = 48
# Partial sums that one task adds up at most, and that the driver does.
FAN_IN = 16
MAX_DRIVER_PARTIALS = 16
# Numbers that the driver takes in per pass; more are added up by tasks first, which shuffles each of them once a pass.
MAX_DRIVER_ENTRIES = 20_000_000
# Steps a label's solver remembers, as single precision: they only shape the next step, so what is solved does not change.
HISTORY = 24
# Directions in which most of the rows' squares lie: what a pass adds up for them is smaller than a gradient of many labels.
DIRECTIONS = 16
SPARE_DIRECTIONS = 8
# Curvature of a label's loss along them, as a share of what C times the rows' squares would give; a rough figure does,
# since it changes the path to the optimum and not the optimum.
CURVATURE = 0.0075

SCORE_SCHEMA = "note_id string, code string, y_proba double"
COEFFICIENT_SCHEMA = "label_code string, intercept double, weights array<double>"
PACK_SCHEMA = "n int, indptr binary, touched binary, cols binary, vals binary, y_indptr binary, y_cols binary"


@dataclass
class Model:
    """Vocabularies and coefficients as tables, the label names, and training facts."""

    vocabularies: DataFrame
    coefficients: DataFrame
    labels: list[str]
    info: dict[str, Any]


def class_weights(labels: DataFrame, vocab: DataFrame, n_notes: int | Any) -> DataFrame:
    """Balanced weights n / (2 * class size) per label; null for an empty class."""
    positives = (
        vocab.select("label_code")
        .join(labels.groupBy("label_code").agg(F.count("*").alias("n")), "label_code", "left")
        .select("label_code", F.coalesce("n", F.lit(0)).alias("n_positive"))
    )
    total = F.lit(n_notes) if isinstance(n_notes, int) else n_notes
    half = total / 2
    sized = positives.withColumn("n_negative", total - F.col("n_positive"))
    return sized.select(
        "label_code",
        "n_positive",
        "n_negative",
        F.when(F.col("n_positive") > 0, half / F.col("n_positive")).alias("weight_positive"),
        F.when(F.col("n_negative") > 0, half / F.col("n_negative")).alias("weight_negative"),
    )


# ---------------------------------------------------------------- packing rows for BLAS


def _as_bytes(rows: Sequence[Sequence[Any]], dtype: Any) -> tuple[bytes, bytes]:
    """Row boundaries and flattened values of ragged rows."""
    bounds = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate([np.asarray(r, dtype=dtype) for r in rows]) if len(rows) else np.empty(0, dtype)
    return bounds.tobytes(), flat.tobytes()


def pack(
    rows: DataFrame,
    label_names: list[str],
    features: np.ndarray,
    vectorise: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
) -> DataFrame:
    """Training rows (indices, values, label_codes) packed a few dozen per row, written once.

    ``features`` are the sorted joint feature ids in use; packed columns are positions in it.
    Small data is kept on few partitions, since each one returns a model-sized gradient.
    """
    spark = rows.sparkSession
    ship_package(spark)
    position = {name: i for i, name in enumerate(label_names)}
    shared = spark.sparkContext.broadcast(features)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if vectorise:
                batch = vectorise(batch)
            packed = []
            for start in range(0, len(batch), ROWS_PER_PACK):
                part = batch.iloc[start : start + ROWS_PER_PACK]
                indptr, flat = _as_bytes(part["indices"].tolist(), np.int64)
                compact = np.searchsorted(shared.value, np.frombuffer(flat, np.int64))
                touched, cols = np.unique(compact, return_inverse=True)
                _, vals = _as_bytes(part["values"].tolist(), np.float64)
                labels = [[position[c] for c in codes if c in position] for codes in part["label_codes"]]
                y_indptr, y_cols = _as_bytes(labels, np.int32)
                packed.append(
                    (
                        len(part),
                        indptr,
                        touched.astype(np.int32).tobytes(),
                        cols.astype(_position_type(len(touched))).tobytes(),
                        vals,
                        y_indptr,
                        y_cols,
                    )
                )
            yield pd.DataFrame(packed, columns=[c.split()[0] for c in PACK_SCHEMA.split(", ")])

    packed = materialize(rows.mapInPandas(run, PACK_SCHEMA), "packed")
    # Each task of a pass returns one gradient, so there are no more tasks than cores.
    return packed.coalesce(packed.sparkSession.sparkContext.defaultParallelism)


def _position_type(n: int) -> type:
    """The narrowest type of a pack's positions among the ``n`` columns it touches."""
    return np.uint16 if n <= 1 << 16 else np.int32


def _opened(indptr: Any, touched: Any, cols: Any, vals: Any) -> tuple[np.ndarray, np.ndarray]:
    """A pack's columns and its rows as a dense matrix over them."""
    indptr, touched = np.frombuffer(indptr, np.int32), np.frombuffer(touched, np.int32)
    x = np.zeros((len(indptr) - 1, len(touched)))
    rows = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
    x[rows, np.frombuffer(cols, _position_type(len(touched)))] = np.frombuffer(vals)
    return touched, x


# ---------------------------------------------------------------- one pass over the data


def _gradient_pass(
    spark: SparkSession,
    packed: DataFrame,
    label_ids: np.ndarray,
    weights: np.ndarray,
    positive: np.ndarray,
    negative: np.ndarray,
    n_parts: int | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Summed loss (labels,) and gradient (labels, features + intercept) at ``weights``.

    The sums of the ``n_parts`` partitions are added up in a tree: no task takes in more
    than FAN_IN of them, and the driver no more than MAX_DRIVER_PARTIALS, or fewer if those
    are over MAX_DRIVER_ENTRIES numbers. Tasks keep a feature's weights of all labels side by
    side, so what a pack touches is read and added in runs of memory.
    """
    n_labels, n_params = weights.shape
    shared = spark.sparkContext.broadcast((label_ids, np.ascontiguousarray(weights.T), positive, negative))

    def add(total: np.ndarray, rows: Iterator[tuple]) -> None:  # gradient, intercept, loss
        ids, w, pos, neg = shared.value
        row_of = np.full(int(ids.max()) + 1, -1)
        row_of[ids] = np.arange(len(ids))
        for n, indptr, touched, cols, vals, y_indptr, y_cols in rows:
            touched, x = _opened(indptr, touched, cols, vals)
            y = np.full((n, n_labels), -1.0)
            who = np.repeat(np.arange(n), np.diff(np.frombuffer(y_indptr, np.int32)))
            what = np.frombuffer(y_cols, np.int32)
            known = what < len(row_of)
            who, what = who[known], row_of[what[known]]
            y[who[what >= 0], what[what >= 0]] = 1.0
            margin = y * (x @ w.take(touched, axis=0) + w[-1])
            cost = np.where(y > 0, pos, neg)
            slope = -cost * y * np.exp(-np.logaddexp(0, margin))
            total[touched] += (slope.T @ x).T
            total[-2] += slope.sum(axis=0)
            total[-1] += (cost * np.logaddexp(0, -margin)).sum(axis=0)

    total = _added_up(packed, add, n_params + 1, n_labels, n_parts)
    shared.destroy()
    return total[-1], np.ascontiguousarray(total[:-1].T)


def _squares_pass(spark: SparkSession, packed: DataFrame, directions: np.ndarray, n_parts: int | None = None) -> np.ndarray:
    """Sum over the rows x of x (x . d) for each column d of ``directions``; the last entry of a row is the intercept's 1."""
    shared = spark.sparkContext.broadcast(directions)

    def add(total: np.ndarray, rows: Iterator[tuple]) -> None:
        d = shared.value
        for _, indptr, touched, cols, vals, _, _ in rows:
            touched, x = _opened(indptr, touched, cols, vals)
            along = x @ d.take(touched, axis=0) + d[-1]
            total[touched] += (along.T @ x).T
            total[-1] += along.sum(axis=0)

    total = _added_up(packed, add, *directions.shape, n_parts)
    shared.destroy()
    return total


def _packs(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The packs of a batch; their bytes are read where Arrow has them."""
    n, *rest = batch.columns
    for i in range(batch.num_rows):
        yield (n[i].as_py(), *(column[i].as_buffer() for column in rest))


def _added_up(
    packed: DataFrame,
    add: Callable[[np.ndarray, Iterator[tuple]], None],
    n_rows: int,
    n_cols: int,
    n_parts: int | None,
) -> np.ndarray:
    """The sum of what ``add`` puts into an (n_rows, n_cols) array of zeros for the packs of each partition."""
    width = max(1, min(n_rows, math.ceil(125_000 / n_cols)))
    chunk_schema = "chunk int, slot int, payload binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((n_rows, n_cols))
        for batch in batches:
            add(total, _packs(batch))
        slot = TaskContext.get().partitionId()
        for start in range(0, n_rows, width):
            piece = [[start // width], [slot], [total[start : start + width].tobytes()]]
            types = (pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(piece, types)], ["chunk", "slot", "payload"])

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p) for p in group["payload"])
        return pd.DataFrame(
            {"chunk": group["chunk"].iloc[:1], "slot": group["slot"].iloc[:1], "payload": [total.tobytes()]}
        )

    parts = packed.mapInArrow(partial, chunk_schema)
    n_parts = n_parts or packed.rdd.getNumPartitions()
    while n_parts > MAX_DRIVER_PARTIALS or (n_parts > 1 and n_parts * n_cols * (n_rows - 1) > MAX_DRIVER_ENTRIES):
        parts = parts.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int"))
        parts = parts.groupBy("chunk", "slot").applyInPandas(combine, chunk_schema)
        n_parts = math.ceil(n_parts / FAN_IN)
    total = np.zeros((n_rows, n_cols))
    sums = parts.select("chunk", "payload").toArrow()
    for chunk, payload in zip(sums["chunk"].to_pylist(), sums["payload"]):
        piece = np.frombuffer(payload.as_buffer()).reshape(-1, n_cols)
        total[chunk * width : chunk * width + len(piece)] += piece
    return total


def main_directions(
    spark: SparkSession, packed: DataFrame, n_params: int, n_parts: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(directions, sums of squares): where the rows' squares lie for the most part, by two passes over all rows.

    Orthonormal columns, in falling order of the sum of (x . d)**2; found by a randomised range finder, so they are close to the
    leading eigenvectors and need not be them.
    """
    n = min(DIRECTIONS + SPARE_DIRECTIONS, n_params)
    start = np.random.default_rng(0).standard_normal((n_params, n))
    basis, _ = np.linalg.qr(_squares_pass(spark, packed, start, n_parts))
    small = basis.T @ _squares_pass(spark, packed, basis, n_parts)
    squares, turn = np.linalg.eigh((small + small.T) / 2)
    kept = np.argsort(-squares)[:DIRECTIONS]
    return np.ascontiguousarray(basis @ turn[:, kept]), np.maximum(squares[kept], 0.0)


# ---------------------------------------------------------------- optimiser


def minimise(
    evaluate: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    n_problems: int,
    n_params: int,
    tolerance: np.ndarray,
    max_iterations: int = MAX_ITERATIONS,
    precondition: Callable[[np.ndarray], np.ndarray] = lambda gradient: gradient,
) -> tuple[np.ndarray, int, np.ndarray]:
    """L-BFGS on independent problems, one trial point of each per evaluation.

    ``evaluate(ids, points)`` returns values and gradients of the named problems. Problems
    do not wait for each other: one whose step is rejected retries a shorter step while
    the others move on, so the evaluations needed are those of the slowest problem.
    A problem stops when its gradient norm falls to ``tolerance`` times the first one, or
    to the floor. Returns the solutions, the number of evaluations and which problems got there;
    one that ran out of iterations or of shorter steps is not among them.

    ``precondition`` stands for the inverse curvature before steps have told it, up to a factor: a symmetric, positive
    definite linear map of one gradient. It shortens the path; what counts as solved stays the same.
    """
    w = np.zeros((n_problems, n_params))
    value, grad = evaluate(np.arange(n_problems), w)
    goal = np.maximum(tolerance * np.linalg.norm(grad, axis=1), GRADIENT_FLOOR)
    history: list[deque[tuple[np.ndarray, np.ndarray, float]]] = [deque(maxlen=HISTORY) for _ in range(n_problems)]  # single precision
    direction = np.array([-precondition(g) for g in grad])
    slope = np.einsum("ij,ij->i", grad, direction)
    step = 1 / np.maximum(1.0, np.linalg.norm(direction, axis=1))
    tries = np.zeros(n_problems, dtype=int)
    evaluations = 1

    def redirect(i: int) -> None:
        q = grad[i].copy()
        alphas = []
        for s, y, rho in reversed(history[i]):
            alpha = rho * (s @ q)
            q -= alpha * y
            alphas.append(alpha)
        q = precondition(q)
        if history[i]:
            s, y, rho = history[i][-1]
            q /= rho * (y @ precondition(y))
        for (s, y, rho), alpha in zip(history[i], reversed(alphas)):
            q += (alpha - rho * (y @ q)) * s
        if q @ grad[i] <= 0:  # lost descent to rounding
            q = grad[i].copy()
        direction[i], slope[i], step[i], tries[i] = -q, -(q @ grad[i]), 1.0, 0

    for _ in range(max_iterations):
        ids = np.flatnonzero((np.linalg.norm(grad, axis=1) > goal) & (tries < 30))
        if not len(ids):
            break
        moved = w[ids] + step[ids, None] * direction[ids]
        new_value, new_grad = evaluate(ids, moved)
        evaluations += 1
        slack = 1e-12 * np.abs(value[ids])
        good = new_value <= value[ids] + 1e-4 * step[ids] * slope[ids] + slack

        bad = ids[~good]
        # Shorter step from the parabola through both values and the slope.
        rise = new_value[~good] - value[bad] - step[bad] * slope[bad]
        bend = -slope[bad] * step[bad] / (2 * np.maximum(rise, 1e-300))
        step[bad] *= np.clip(bend, 0.1, 0.5)
        tries[bad] += 1

        for row in np.flatnonzero(good):
            i = ids[row]
            moved_by, turned_by = moved[row] - w[i], new_grad[row] - grad[i]
            w[i], value[i], grad[i] = moved[row], new_value[row], new_grad[row]
            curvature = moved_by @ turned_by
            if curvature > 1e-12 * (turned_by @ turned_by):
                history[i].append((moved_by.astype(np.float32), turned_by.astype(np.float32), 1 / curvature))
            redirect(i)
    return w, evaluations, np.linalg.norm(grad, axis=1) <= goal


# ---------------------------------------------------------------- fitting


def _groups(n_labels: int, n_params: int) -> list[range]:
    size = max(1, MAX_GROUP_ENTRIES // n_params)
    return [range(i, min(i + size, n_labels)) for i in range(0, n_labels, size)]


def _flattener(directions: np.ndarray, curvature: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Inverse of the identity plus ``curvature`` along orthonormal ``directions``."""
    shrink = 1 / (1 + curvature) - 1
    return lambda gradient: gradient + directions @ (shrink * (gradient @ directions))


def fit_packed(
    spark: SparkSession,
    packed: DataFrame,
    label_names: list[str],
    positives: dict[str, int],
    n_notes: int,
    features: np.ndarray,
    n_features: int,
    *,
    c: float = C,
    tolerance: float = TOLERANCE,
    max_iterations: int = MAX_ITERATIONS,
) -> tuple[DataFrame, int, list[str]]:
    """Coefficient table for packed training rows, the data passes taken, and labels that did not converge.

    ``features`` are the joint feature ids behind the packed columns; coefficients cover all
    ``n_features``. A label that every or no row has gets zero weights and an infinite intercept, so its
    probability is the constant 1 or 0.
    """
    path = scratch_path(spark, "coefficients")
    passes, unsettled = 0, []
    n_parts = packed.rdd.getNumPartitions()
    n_params = len(features) + 1
    flatten = None
    for group in _groups(len(label_names), n_params):
        counts = np.array([positives.get(label_names[i], 0) for i in group], dtype=float)
        varied = np.flatnonzero((counts > 0) & (counts < n_notes))
        weights = np.zeros((len(group), n_params))
        weights[counts == 0, -1] = -np.inf
        weights[(counts == n_notes) & (counts > 0), -1] = np.inf
        if len(varied):
            ids = np.array(group)[varied]
            pos = c * n_notes / (2 * counts[varied])
            neg = c * n_notes / (2 * (n_notes - counts[varied]))

            def evaluate(which, points):
                loss, grad = _gradient_pass(spark, packed, ids[which], points, pos[which], neg[which], n_parts)
                return loss + 0.5 * np.einsum("ij,ij->i", points, points), grad + points

            rarity = np.minimum(counts[varied], n_notes - counts[varied]) / n_notes
            if flatten is None:
                directions, squares = main_directions(spark, packed, n_params, n_parts)
                flatten = _flattener(directions, CURVATURE * c * squares)
                passes += 2
            solved, used, settled = minimise(
                evaluate, len(varied), n_params, tolerance * rarity, max_iterations, flatten
            )
            weights[varied] = solved
            passes += used
            unsettled += [label_names[i] for i in ids[~settled]]
        full = np.zeros((len(group), n_features))
        full[:, features] = weights[:, :-1]
        rows = pd.DataFrame(
            {
                "label_code": [label_names[i] for i in group],
                "intercept": weights[:, -1],
                "weights": list(full),
            }
        )
        # An Arrow table is taken as it is, whatever the session's settings for pandas are.
        table = pa.table({"label_code": rows["label_code"], "intercept": rows["intercept"], "weights": list(full)})
        spark.createDataFrame(table, COEFFICIENT_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(COEFFICIENT_SCHEMA).parquet(path), passes, unsettled


def _names(vocab: DataFrame) -> list[str]:
    """Label names in order; as many as the label vocabulary, not the data."""
    return sorted(row.label_code for row in vocab.select("label_code").collect())


def _feature_ids(vocabularies: DataFrame, blocks) -> np.ndarray:
    """Sorted joint feature ids in use; at most the blocks' max_features together."""
    offsets = block_offsets(blocks)
    rows = vocabularies.select("block", "feature_id").toPandas()
    return np.sort((rows["feature_id"] + rows["block"].map(offsets)).to_numpy(dtype=np.int64))


def fit(notes: DataFrame, labels: DataFrame, vocab: DataFrame, *, blocks=BLOCKS, **options: Any) -> Model:
    """Fit features and all label models on (note_id, note_text) and (note_id, label_code)."""
    spark = notes.sparkSession
    vocabularies = materialize(fit_vocabularies(notes, blocks), "vocabulary")
    names = _names(vocab)
    rows = labels_per_note(feature_vectors(notes, vocabularies, blocks), labels)
    features = _feature_ids(vocabularies, blocks)
    packed = pack(rows, names, features)
    n_notes = packed.agg(F.sum("n")).first()[0] or 0
    counts = {row.label_code: row["count"] for row in labels.groupBy("label_code").count().collect()}
    n_features = sum(block.max_features for block in blocks)
    coefficients, passes, unsettled = fit_packed(spark, packed, names, counts, n_notes, features, n_features, **options)
    facts = {"n_notes": n_notes, "n_codes_kept": len(names), "n_passes": passes, "not_converged": unsettled}
    return Model(vocabularies, coefficients, names, facts)


# ---------------------------------------------------------------- scoring


def score_vectors(
    vectors: DataFrame,
    coefficients: DataFrame,
    n_features: int,
    *,
    min_proba: float | None = None,
    vectorise: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    truth: bool = False,
) -> DataFrame:
    """(note_id, code, y_proba) for every note and label, or only those at ``min_proba`` or above.

    Coefficients travel to the tasks in label groups of bounded size; with ``min_proba``
    the rows below it are never emitted. With ``truth`` a column y_true tells whether the
    code is among the note's ``label_codes``; rows of true codes are emitted in any case.
    """
    spark = vectors.sparkSession
    schema = SCORE_SCHEMA + ", y_true int" * truth
    ship_package(spark)
    parts = [vectors.mapInPandas(_scorer(s, min_proba, vectorise, truth), schema) for s in _shared_groups(coefficients, n_features)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _shared_groups(coefficients: DataFrame, n_features: int) -> Iterator[Any]:
    """Broadcasts of (codes, weights, intercepts), one per label group of bounded size."""
    names = _names(coefficients)
    for group in _groups(len(names), n_features + 1):
        members = [names[i] for i in group]
        rows = coefficients.where(F.col("label_code").isin(members)).toArrow().sort_by("label_code")
        matrix = np.empty((n_features, len(rows)))  # a feature's weights of all labels side by side
        for i, weights in enumerate(rows["weights"]):
            matrix[:, i] = weights.values.to_numpy(zero_copy_only=False)
        yield coefficients.sparkSession.sparkContext.broadcast((members, matrix, rows["intercept"].to_numpy()))


def _probabilities(ends: np.ndarray, ids: np.ndarray, values: np.ndarray, matrix: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """(rows, labels) of sparse rows; only weights of a row's own features are read."""
    margin = np.empty((len(ends) - 1, matrix.shape[1]))
    for i, (a, b) in enumerate(pairwise(ends.tolist())):
        margin[i] = values[a:b] @ matrix.take(ids[a:b], axis=0)
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-(margin + intercepts)))


def _scorer(shared, min_proba, vectorise, truth):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, matrix, intercepts = shared.value
        code_array = np.array(codes, dtype=object)
        place = {code: i for i, code in enumerate(codes)}
        for batch in batches:
            if vectorise:
                batch = vectorise(batch)
            for start in range(0, len(batch), ROWS_PER_PACK):
                part = batch.iloc[start : start + ROWS_PER_PACK]
                bounds = np.cumsum([0, *map(len, part["indices"])])
                cols = np.concatenate([np.asarray(v, dtype=np.int64) for v in part["indices"]])
                vals = np.concatenate([np.asarray(v, dtype=float) for v in part["values"]])
                proba = _probabilities(bounds, cols, vals, matrix, intercepts)
                ids = np.repeat(part["note_id"].to_numpy(), len(codes))
                frame = pd.DataFrame(
                    {"note_id": ids, "code": np.tile(code_array, len(part)), "y_proba": proba.ravel()}
                )
                if truth:
                    has = np.zeros((len(part), len(codes)), dtype=np.int32)
                    for row, own in zip(has, part["label_codes"], strict=True):
                        row[[place[c] for c in own if c in place]] = 1
                    frame["y_true"] = has.ravel()
                if min_proba is None:
                    yield frame
                else:
                    kept = frame["y_proba"] >= min_proba
                    yield frame[kept | (frame["y_true"] == 1)] if truth else frame[kept]

    return run


def score_notes(notes: DataFrame, model: Model, *, blocks=BLOCKS, min_proba: float | None = None) -> DataFrame:
    """Score (note_id, note_text) with a model, as ``score_vectors`` does.

    A note's vector is scored by the task that makes it and never leaves it.
    """
    spark = notes.sparkSession
    n_features = sum(block.max_features for block in blocks)
    parts = [
        map_vectors(notes, model.vocabularies, _giver(s, min_proba), lambda _: SCORE_SCHEMA, blocks)
        for s in _shared_groups(model.coefficients, n_features)
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], SCORE_SCHEMA)


def _giver(shared: Any, min_proba: float | None) -> Callable[..., pa.RecordBatch]:
    def give(note_id: pa.Array, ends: np.ndarray, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        codes, matrix, intercepts = shared.value
        proba = _probabilities(ends, ids, values, matrix, intercepts)
        row, code = np.nonzero(proba >= min_proba) if min_proba is not None else np.indices(proba.shape).reshape(2, -1)
        columns = [note_id.cast(pa.string()).take(pa.array(row)), pa.array(codes, pa.string()).take(pa.array(code)), pa.array(proba[row, code])]
        return pa.RecordBatch.from_arrays(columns, ["note_id", "code", "y_proba"])

    return give


__all__ = [
    "Model",
    "block_offsets",
    "class_weights",
    "fit",
    "fit_packed",
    "minimise",
    "pack",
    "score_notes",
    "score_vectors",
]
