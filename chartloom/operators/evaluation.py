"""Classification metrics over long prediction tables.

Input rows are (note_id, code, y_true, y_pred, y_proba), dense over notes and codes,
optionally with group columns such as fold or rollup. Count metrics also take ``Sparse`` predictions, which
hold only the rows that are true or predicted; all other cells follow by subtraction.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions import scores as sc
from chartloom.operators.ranking import first_by

# The sweep runs from 0.10 to 0.90 in steps of 0.05.
THRESHOLDS = tuple(k / 100 for k in range(10, 91, 5))
# Upper bounds (inclusive) and names of the support buckets; the last is open.
SUPPORT_BUCKETS = ((5, "1-5"), (15, "6-15"), (30, "16-30"), (50, "31-50"), (None, "51+"))
DEFAULT_THRESHOLD = 0.5


@dataclass(frozen=True)
class Sparse:
    """Predictions without the cells that are neither true nor at ``floor`` or above.

    ``rows`` are the cells kept; ``notes`` lists every scored note once, with the group columns; ``codes`` lists
    every code (``code``) once, or once per group if codes differ between groups. Group columns are not null.
    """

    rows: DataFrame
    notes: DataFrame
    codes: DataFrame
    floor: float

    def sizes(self, by: Sequence[str]) -> DataFrame:
        """Notes of every group that has any."""
        return self.notes.groupBy(*by).agg(F.count("*").alias("_n")).where("_n > 0")

    def cells(self, by: Sequence[str]) -> DataFrame:
        """Every (group, code) with the group's notes; as large as groups times vocabulary."""
        shared = [c for c in by if c in self.codes.columns]
        if shared:
            return self.sizes(by).join(self.codes.select(*shared, "code"), shared)
        names = self.codes.agg(F.collect_list("code")).scalar()
        return self.sizes(by).withColumn("_codes", names).select(*by, "_n", F.explode("_codes").alias("code"))

    def with_group(self, name: str) -> Sparse:
        """The same predictions as one group."""
        one = F.lit(0)
        return Sparse(self.rows.withColumn(name, one), self.notes.withColumn(name, one), self.codes, self.floor)


Predictions = DataFrame | Sparse


def sparse(predictions: DataFrame, notes: DataFrame, codes: DataFrame, floor: float = THRESHOLDS[0]) -> Sparse:
    """The sparse form of dense predictions; ``floor`` must not lie above one half, where rows are predicted."""
    if floor > DEFAULT_THRESHOLD:
        raise ValueError("predicted rows would be lost")
    return Sparse(predictions.where((F.col("y_true") == 1) | (F.col("y_proba") >= floor)), notes, codes, floor)


def confusion_per_code(predictions: Predictions, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, support and predicted positives of every code, in one pass."""
    if isinstance(predictions, Sparse):
        return _sparse_confusion(predictions, by)
    truth, guess = F.col("y_true") == 1, F.col("y_pred") == 1
    return predictions.groupBy(*by, "code").agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
        F.count_if(truth).alias("support"),
        F.count_if(guess).alias("pred_positive"),
    )


def _sparse_confusion(predictions: Sparse, by: Sequence[str]) -> DataFrame:
    truth, guess = F.col("y_true") == 1, F.col("y_pred") == 1
    seen = predictions.rows.groupBy(*by, "code").agg(
        F.count_if(truth & guess).alias("tp"), F.count_if(~truth & guess).alias("fp"), F.count_if(truth & ~guess).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    counted = predictions.cells(by).join(seen, [*by, "code"], "left").na.fill(0, ["tp", "fp", "fn"])
    return counted.select(
        *by, "code", "tp", "fp", "fn", (F.col("_n") - tp - fp - fn).alias("tn"), (tp + fn).alias("support"), (tp + fp).alias("pred_positive")
    )


def per_code_scores(predictions: Predictions, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with unrounded precision, recall and F1."""
    return confusion_per_code(predictions, by).withColumns(sc.ratios())


def per_code_stats(predictions: Predictions) -> DataFrame:
    """The per-code report: ratios rounded to three digits."""
    return per_code_scores(predictions).select(
        "code",
        "support",
        "pred_positive",
        *[F.round(name, 3).alias(name) for name in ("precision", "recall", "f1")],
        "fn",
        "fp",
    )


def averaged_scores(per_code: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Micro scores from summed counts, macro scores as the mean over every code."""
    sums = per_code.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")],
        F.count("*").alias("n_codes"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
    )
    return sums.withColumns(
        {
            **sc.ratios("micro_"),
            "hamming_loss": sc.error_share(),
        }
    )


def micro_scores(predictions: Predictions, by: Sequence[str] = ()) -> DataFrame:
    return averaged_scores(per_code_scores(predictions, by), by).select(
        *by, "micro_precision", "micro_recall", "micro_f1"
    )


def macro_scores(predictions: Predictions, by: Sequence[str] = ()) -> DataFrame:
    return averaged_scores(per_code_scores(predictions, by), by).select(
        *by, "macro_precision", "macro_recall", "macro_f1"
    )


def hamming_loss(predictions: Predictions, by: Sequence[str] = ()) -> DataFrame:
    return averaged_scores(per_code_scores(predictions, by), by).select(*by, "hamming_loss")


def subset_accuracy(predictions: Predictions, by: Sequence[str] = ()) -> DataFrame:
    """Share of notes whose every code is predicted right."""
    if isinstance(predictions, Sparse):
        wrong = predictions.rows.where("y_true <> y_pred").select(*by, "note_id").distinct()
        counts = wrong.groupBy(*by).agg(F.count("*").alias("_wrong"))
        sizes = predictions.sizes(by)
        joined = sizes.join(counts, list(by), "left") if by else sizes.withColumn("_wrong", counts.scalar())
        right = 1 - F.coalesce("_wrong", F.lit(0)) / F.col("_n")
        return joined.select(*by, right.alias("subset_accuracy"), F.col("_n").alias("n_notes"))
    wrong = predictions.groupBy(*by, "note_id").agg(
        F.max((F.col("y_true") != F.col("y_pred")).cast("int")).alias("wrong")
    )
    return wrong.groupBy(*by).agg(
        F.avg(1 - F.col("wrong")).alias("subset_accuracy"), F.count("*").alias("n_notes")
    )


def score_table(predictions: Predictions, by: Sequence[str] = ()) -> DataFrame:
    """One row per group: sizes, micro/macro F1, subset accuracy, Hamming loss."""
    keys = list(by) or ["_all"]
    rows = predictions
    if not by:
        rows = rows.with_group("_all") if isinstance(rows, Sparse) else rows.withColumn("_all", F.lit(0))
    averaged = averaged_scores(per_code_scores(rows, keys), keys)
    return averaged.join(subset_accuracy(rows, keys), keys).select(
        *by, "n_notes", "n_codes", "micro_f1", "macro_f1", "subset_accuracy", "hamming_loss"
    )


def fold_scores(oof: Predictions) -> DataFrame:
    """Scores of each fold with its training and validation size."""
    notes = oof.notes if isinstance(oof, Sparse) else oof
    total = notes.agg(F.count_distinct("note_id")).scalar()
    return score_table(oof, ["fold"]).select(
        "fold",
        (total - F.col("n_notes")).alias("n_train"),
        F.col("n_notes").alias("n_val"),
        "micro_f1",
        "macro_f1",
        "subset_accuracy",
        "hamming_loss",
    )


def fold_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population standard deviation of micro and macro F1 over folds."""
    return per_fold.agg(
        F.count("*").alias("n_folds"),
        F.avg("micro_f1").alias("mean_micro_f1"),
        F.stddev_pop("micro_f1").alias("std_micro_f1"),
        F.avg("macro_f1").alias("mean_macro_f1"),
        F.stddev_pop("macro_f1").alias("std_macro_f1"),
    )


def threshold_sweep(predictions: Predictions, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Micro and macro scores at each threshold (``y_proba >= t``), from one pass.

    Each probability is replaced by the number of thresholds it reaches; counting those
    per code leaves at most len(thresholds) + 1 rows per code, from which every
    threshold's counts follow as sums over the bins at or above it.
    """
    rows = predictions.rows if isinstance(predictions, Sparse) else predictions
    if isinstance(predictions, Sparse) and predictions.floor > min(thresholds):
        raise ValueError("rows below the lowest threshold are needed")
    reached = sum((F.col("y_proba") >= t).cast("int") for t in thresholds)
    bins = rows.groupBy("code", reached.alias("bin")).agg(
        F.sum("y_true").alias("positives"), F.count("*").alias("n")
    )
    steps = [
        F.struct(
            F.lit(t).alias("threshold"),
            F.sum(F.when(F.col("bin") >= i, F.col("positives")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("bin") >= i, F.col("n") - F.col("positives")).otherwise(0)).alias("fp"),
            F.sum(F.when(F.col("bin") < i, F.col("positives")).otherwise(0)).alias("fn"),
            F.sum(F.when(F.col("bin") < i, F.col("n") - F.col("positives")).otherwise(0)).alias("tn"),
        )
        for i, t in enumerate(thresholds, start=1)
    ]
    per_code = bins.groupBy("code").agg(F.array(*steps).alias("steps"), F.sum("n").alias("n"))
    if isinstance(predictions, Sparse):
        zero = F.lit(0).cast("long")
        none = [F.struct(F.lit(t).alias("threshold"), *[zero.alias(c) for c in ("tp", "fp", "fn", "tn")]) for t in thresholds]
        every = predictions.cells(()).join(per_code, "code", "left")
        # Cells without a row are true negatives at every threshold.
        per_code = every.select(
            "code",
            F.inline(F.coalesce("steps", F.array(*none))),
            (F.col("_n") - F.coalesce("n", zero)).alias("_rest"),
        ).withColumn("tn", F.col("tn") + F.col("_rest"))
    else:
        per_code = per_code.select("code", F.inline("steps"))
    scored = per_code.withColumns(sc.ratios())
    names = [f"{kind}_{name}" for kind in ("micro", "macro") for name in ("precision", "recall", "f1")]
    return averaged_scores(scored, ["threshold"]).select("threshold", *names)


def best_threshold(sweep: DataFrame, metrics: Sequence[str] = ("micro_f1", "macro_f1")) -> DataFrame:
    """The sweep row that maximises each metric; the lowest threshold wins ties."""
    options = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("metric_value")) for m in metrics]
    )
    return first_by(
        sweep.select("*", F.inline(options)), ["metric"], [F.desc("metric_value"), F.asc("threshold")]
    )


def cv_headline(summary: DataFrame, best: DataFrame) -> DataFrame:
    """One row: fold mean and deviation beside the best operating points."""
    points = best.agg(
        *[
            F.max(F.when(F.col("metric") == metric, F.col(column))).alias(f"best_{metric}_{name}")
            for metric in ("micro_f1", "macro_f1")
            for column, name in (("threshold", "threshold"), ("metric_value", "value"))
        ]
    )
    return summary.withColumn("_one", F.lit(1)).join(points.withColumn("_one", F.lit(1)), "_one").drop("_one")


def f1_summary(stats: DataFrame) -> DataFrame:
    """How many codes have zero, low and high F1."""
    f1 = F.col("f1")
    return stats.agg(
        F.count("*").alias("total_codes"),
        F.count_if(f1 == 0).alias("zero_f1"),
        F.count_if(f1 < 0.5).alias("low_f1"),
        F.count_if(f1 >= 0.8).alias("high_f1"),
    )


def min_support_summary(stats: DataFrame, min_support: int) -> DataFrame:
    """Scores with and without the codes below a support limit."""
    included = F.col("support") >= min_support
    tp = F.col("support") - F.col("fn")

    def proxy(wanted):
        hits = F.sum(F.when(wanted, tp).otherwise(0))
        errors = F.sum(F.when(wanted, F.col("fp") + F.col("fn")).otherwise(0))
        return sc.safe_ratio(hits, hits + errors * 0.5)

    return stats.agg(
        F.lit(min_support).alias("min_support"),
        F.count_if(included).alias("n_included"),
        F.count_if(~included).alias("n_excluded"),
        F.avg(F.when(included, F.col("f1"))).alias("mean_f1_included"),
        F.avg(F.when(~included, F.col("f1"))).alias("mean_f1_excluded"),
        proxy(included).alias("micro_f1_included"),
        proxy(F.col("support") > 0).alias("micro_f1_all"),
    )


def support_buckets(stats: DataFrame) -> DataFrame:
    """F1 by support range; codes without support are left out."""
    bucket = F
    for upper, name in SUPPORT_BUCKETS:
        bucket = bucket.otherwise(name) if upper is None else bucket.when(F.col("support") <= upper, name)
    return (
        stats.where("support > 0")
        .groupBy(bucket.alias("bucket"))
        .agg(
            F.count("*").alias("n_codes"),
            F.avg("f1").alias("mean_f1"),
            F.min("f1").alias("min_f1"),
            F.max("f1").alias("max_f1"),
        )
    )


def worst_codes(stats: DataFrame, n: int = 20) -> DataFrame:
    return stats.orderBy("f1", "code").limit(n)


def best_codes(stats: DataFrame, n: int = 10) -> DataFrame:
    return stats.orderBy(F.desc("f1"), "code").limit(n)


def top_codes_by_support(stats: DataFrame, n: int = 20) -> DataFrame:
    return stats.orderBy(F.desc("support"), "code").limit(n)


def rollup_comparison(predictions: Predictions) -> DataFrame:
    """Score table with one row per rollup."""
    return score_table(predictions, ["rollup"])


def sample_prediction(predictions: DataFrame, notes: DataFrame) -> DataFrame:
    """True and predicted codes of the first note that has a true code, with its head."""
    from chartloom.functions.text import preview

    first = predictions.where("y_true = 1").agg(F.min("note_id")).scalar()

    def codes(flag):
        hit = F.collect_list(F.when(F.col(flag) == 1, F.col("code")))
        return F.array_join(F.sort_array(hit), ",")

    return (
        predictions.where(F.col("note_id") == first)
        .groupBy("note_id")
        .agg(codes("y_true").alias("truth"), codes("y_pred").alias("predicted"))
        .join(notes.select("note_id", preview(F.col("note_text")).alias("head")), "note_id")
    )


def ranked_predictions(predictions: DataFrame) -> DataFrame:
    """Predictions of each note numbered by confidence, then code."""
    order = Window.partitionBy("note_id").orderBy(F.desc("confidence"), "code")
    return predictions.withColumn("rank", F.row_number().over(order))
