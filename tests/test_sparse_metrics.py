"""Metrics of sparse predictions against those of the dense rows they leave out."""

import pytest
from pyspark.sql import functions as F

from chartloom.operators import evaluation as ev
from chartloom.operators import predict as pr


@pytest.fixture(scope="module")
def dense(spark):
    cells = spark.range(40 * 7).select(
        F.concat(F.lit("n"), (F.col("id") / 7).cast("int")).alias("note_id"),
        F.concat(F.lit("c"), F.col("id") % 7).alias("code"),
        F.when((F.col("id") % 7 == 6) | (F.col("id") % 5 != 0), 0).otherwise(1).alias("y_true"),
        # Code c6 is never true and never near a threshold.
        F.when(F.col("id") % 7 == 6, 0.01).otherwise(F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0).alias("y_proba"),
        ((F.col("id") / 7).cast("int") % 3).alias("fold"),
    )
    return pr.predict_default(cells)


@pytest.fixture(scope="module")
def kept(dense):
    return ev.sparse(dense, dense.select("note_id", "fold").distinct(), dense.select("code").distinct())


def close(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    columns = sorted(left.columns)
    a, b = (sorted([tuple(r[c] for c in columns) for r in d.collect()], key=str) for d in (left, right))
    assert len(a) == len(b) > 0
    for x, y in zip(a, b, strict=True):
        assert x == pytest.approx(y)


@pytest.mark.parametrize(
    "metric",
    [
        ev.confusion_per_code, ev.per_code_stats, ev.micro_scores, ev.macro_scores, ev.hamming_loss, ev.subset_accuracy,
        ev.score_table, ev.fold_scores, ev.threshold_sweep,
        lambda p: ev.confusion_per_code(p, ["fold"]), lambda p: ev.subset_accuracy(p, ["fold"]), lambda p: ev.score_table(p, ["fold"]),
    ],
)
def test_sparse_equals_dense(metric, dense, kept):
    assert kept.rows.count() < dense.count()
    close(metric(kept), metric(dense))


def test_codes_of_a_group_are_its_own(spark, kept, dense):
    codes = spark.createDataFrame([(0, "c0"), (1, "c0"), (1, "c1"), (2, "c6")], "fold int, code string")
    table = ev.confusion_per_code(ev.Sparse(kept.rows, kept.notes, codes, kept.floor), ["fold"])
    close(table, ev.confusion_per_code(dense, ["fold"]).join(codes, ["fold", "code"], "left_semi"))


def test_floor_is_checked_and_nothing_gives_nothing(dense, kept):
    with pytest.raises(ValueError):
        ev.sparse(dense, kept.notes, kept.codes, 0.6)
    with pytest.raises(ValueError):
        ev.threshold_sweep(ev.sparse(dense, kept.notes, kept.codes, 0.5))
    none = ev.Sparse(kept.rows.where("false"), kept.notes.where("false"), kept.codes, kept.floor)
    assert ev.confusion_per_code(none).isEmpty() and ev.score_table(none).isEmpty()
    silent = ev.Sparse(kept.rows.where("false"), kept.notes, kept.codes, kept.floor)
    assert [r.tn for r in ev.confusion_per_code(silent).collect()] == [40] * 7
    assert ev.subset_accuracy(silent).first().subset_accuracy == 1.0


def test_codes_and_groups_meet_without_a_cross_join(kept):
    plan = ev.confusion_per_code(kept)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "Join Cross" not in plan
