"""Labels, notes, splits, datasets, metrics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartloom.operators import dataset as ds
from chartloom.operators import evaluation as ev
from chartloom.operators import labels as lb
from chartloom.operators import notes as nt
from chartloom.operators import predict as pr
from chartloom.operators import splits as sp

T = dt.datetime
PREDICTIONS = "note_id string, code string, y_true int, y_pred int, y_proba double"


def test_rollup(spark, rows):
    df = spark.createDataFrame(
        [("n", "K06.8", False), ("n", "K06.9", True), ("n", "z73", True), ("n", "Z1", True), ("m", "Q", False)],
        "note_id string, icd10_code string, is_primary boolean",
    )
    assert rows(lb.rollup_labels(df)) == [("m", "Q", False), ("n", "K06", True)]
    assert rows(lb.rollup_labels(df, "chapter")) == [("m", "Q", False), ("n", "K", True)]
    assert lb.rollup_labels(df, "dirty").count() == 5
    assert lb.drop_zcodes(df, case_sensitive=True).count() == 4
    with pytest.raises(ValueError):
        lb.rollup_labels(df, "nope")


def test_latest_note_ties_go_to_greatest_id(spark, rows):
    t = T(2026, 1, 1)
    df = spark.createDataFrame(
        [("a", "p", "s", t), ("b", "p", "s", t), ("c", "p", "s", t - dt.timedelta(1)), ("d", "q", "s", t)],
        "note_id string, patient_id string, strategy string, generated_at timestamp",
    )
    latest = nt.latest_notes(df)
    assert rows(latest, "note_id") == [("b",), ("d",)]
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()


def test_fanout_refuses_unknown_strategy(spark):
    with pytest.raises(ValueError):
        nt.strategy_fanout(spark.range(1), ["multilabel", "nope"])


def test_validation(spark, rows):
    df = spark.createDataFrame(
        [("x" * 10, "encounter", 0.0), ("x" * 9, "encounter", 0.5), ("x" * 10, "encounter", 1.01), ("x" * 10, "other", 1.0), (" " * 12, "patient", 1.0)],
        "note_text string, model string, threshold double",
    )
    assert [r.is_valid for r in nt.validate_requests(df).collect()] == [True, False, False, False, True]
    assert [r.is_valid for r in nt.validate_requests(df, strip=True).collect()] == [True, False, False, False, False]


def test_cost(spark):
    df = spark.createDataFrame([(1_000_000, 2_000_000), (None, None)], "input_tokens long, output_tokens long")
    assert nt.generation_cost(df).first().cost_usd == pytest.approx(0.30 + 5.0)
    assert nt.cost_preview(spark.range(100), 2).first().needs_confirmation


def pair_labels(spark, n=400):
    keys = spark.range(n).select(F.format_string("k%d", "id").alias("key"), "id")
    return keys.select("key", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 9).cast("string"))).alias("label_code")).union(
        keys.where("id % 10 = 0").select("key", F.lit("extra"))
    )


def test_folds_are_balanced_disjoint_and_stable(spark):
    labels = pair_labels(spark)
    folds = sp.stratified_folds(labels, 5)
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert sum(sizes) == 400 and max(sizes) - min(sizes) <= 1 and len(sizes) == 5
    assert folds.select("key").distinct().count() == 400
    assert folds.exceptAll(sp.stratified_folds(labels.orderBy(F.rand()), 5)).isEmpty()
    spread = folds.groupBy("stratum", "fold").count().groupBy("stratum").agg((F.max("count") - F.min("count")).alias("d"))
    assert spread.agg(F.max("d")).first()[0] <= 1


def test_split_keeps_carried_keys_and_drops_gone_ones(spark, rows):
    labels = pair_labels(spark, 50)
    current = labels.select("key").distinct().union(spark.createDataFrame([("empty",)], "key string"))
    old = spark.createDataFrame([("k1", "test"), ("k2", "dev"), ("gone", "dev")], "key string, bucket string")
    merged = sp.assert_disjoint(sp.merge_split(old, current, labels))
    found = dict(rows(merged))
    assert found["k1"] == "test" and found["k2"] == "dev" and "gone" not in found and "empty" not in found
    assert len(found) == 50
    report = sp.split_report(old, current, merged, labels).first()
    assert (report.n_total, report.n_orphaned, report.n_skipped_empty, report.n_carried_test) == (50, 1, 1, 1)
    with pytest.raises(ValueError):
        sp.assert_disjoint(old.union(spark.createDataFrame([("k1", "dev")], "key string, bucket string")))


def test_encounter_split_is_exact(spark):
    keys = spark.range(104).select(F.col("id").cast("string").alias("key"))
    counts = {r.bucket: r["count"] for r in sp.encounter_split(keys).groupBy("bucket").count().collect()}
    assert counts == {"test": 20, "dev": 84}


def test_dataset_uses_dev_vocabulary_and_drops_empty_notes(spark, rows):
    t = T(2026, 1, 1)
    notes = spark.createDataFrame(
        [(f"n{i}", f"p{i}", "multilabel", t, f"text {i}") for i in range(6)],
        "note_id string, patient_id string, strategy string, generated_at timestamp, note_text string",
    )
    labels = spark.createDataFrame(
        [(f"n{i}", "A01.0", False) for i in range(4)] + [("n4", "B01", False), ("n5", "A01", False), ("n5", "C01", True), ("n5", "C01.1", True)],
        "note_id string, icd10_code string, is_primary boolean",
    )
    split = spark.createDataFrame(
        [(f"p{i}::multilabel", "dev" if i < 5 else "test") for i in range(6)], "key string, bucket string"
    )
    dev = ds.load_patient_dataset(notes, labels, split, bucket="dev")
    info = dev.info.first()
    assert (info.n_notes, info.n_notes_dropped_empty, info.n_codes_kept, info.n_codes_dropped_rare) == (4, 1, 1, 1)
    test = ds.load_patient_dataset(notes, labels, split, bucket="test")
    assert rows(test.labels) == [("n5", "A01")]
    assert rows(ds.binarize(test.notes, lb.rollup_labels(labels), dev.vocab)) == [("n5", "A01", 1)]
    empty = ds.load_patient_dataset(notes, labels, split.where("false"), bucket="all").info.first()
    assert (empty.n_notes, empty.avg_labels_per_note) == (0, 0.0)
    with pytest.raises(ValueError):
        ds.load_patient_dataset(notes, labels, split, bucket="nope")
    labels = labels.unionByName(labels.limit(3)).unionByName(labels.withColumn("icd10_code", F.lit("Z00.1")))
    rollups, buckets = ("dirty", "3char", "chapter"), ("dev", "test", "all")
    current = notes.select("note_id", F.concat("patient_id", F.lit("::multilabel")).alias("key"))
    for kept in (split, split.where("bucket = 'dev'"), split.where("false")):
        each = [ds.load_patient_dataset(notes, labels, kept, rollup=r, bucket=b).info for r in rollups for b in buckets]
        at_once = ds.dataset_infos(current, labels, kept, rollups=rollups, buckets=buckets)
        assert rows(at_once, *each[0].columns) == sorted((tuple(i.first()) for i in each), key=str)
    with pytest.raises(ValueError):
        ds.dataset_infos(current, labels, split, rollups=rollups, buckets=("nope",))


@pytest.fixture
def predictions(spark):
    return spark.createDataFrame(
        [
            ("a", "A", 1, 1, 0.9), ("a", "B", 0, 1, 0.6), ("a", "C", 0, 0, 0.1),
            ("b", "A", 1, 0, 0.4), ("b", "B", 0, 0, 0.2), ("b", "C", 0, 0, 0.1),
            ("c", "A", 0, 0, 0.1), ("c", "B", 0, 0, 0.1), ("c", "C", 0, 0, 0.1),
        ],
        PREDICTIONS,
    )


def test_metrics_with_zero_division(predictions, rows):
    stats = {r.code: r for r in ev.per_code_stats(predictions).collect()}
    assert (stats["A"].precision, stats["A"].recall, stats["A"].f1) == (1.0, 0.5, 0.667)
    assert (stats["B"].precision, stats["C"].f1) == (0.0, 0.0)
    micro = ev.micro_scores(predictions).first()
    assert (micro.micro_precision, micro.micro_recall) == (0.5, 0.5)
    assert ev.macro_scores(predictions).first().macro_f1 == pytest.approx(2 / 9)
    assert ev.subset_accuracy(predictions).first().subset_accuracy == pytest.approx(1 / 3)
    assert ev.hamming_loss(predictions).first().hamming_loss == pytest.approx(2 / 9)


def test_sweep_matches_direct_scoring_and_ties_go_low(predictions):
    sweep = {round(r.threshold, 2): r for r in ev.threshold_sweep(predictions).collect()}
    assert len(sweep) == 17
    for t in (0.1, 0.4, 0.6, 0.65, 0.9):
        direct = ev.averaged_scores(ev.per_code_scores(predictions.withColumn("y_pred", (F.col("y_proba") >= t).cast("int")))).first()
        assert sweep[t].micro_f1 == pytest.approx(direct.micro_f1) and sweep[t].macro_f1 == pytest.approx(direct.macro_f1)
    best = {r.metric: r.threshold for r in ev.best_threshold(ev.threshold_sweep(predictions)).collect()}
    # Macro is 1/3 at both 0.15 and 0.25.
    assert best == {"micro_f1": 0.25, "macro_f1": 0.15}


def test_support_buckets_are_right_closed_and_open_ended(spark, rows):
    stats = spark.createDataFrame([("a", 0, 0.5), ("b", 5, 0.2), ("c", 6, 0.4), ("d", 50, 0.5), ("e", 20000, 0.9)], "code string, support long, f1 double")
    assert rows(ev.support_buckets(stats), "bucket", "n_codes") == [("1-5", 1), ("31-50", 1), ("51+", 1), ("6-15", 1)]


def test_prediction_rules(spark, rows):
    scored = spark.createDataFrame([("n", "A", 0.5), ("n", "B", 0.50004), ("n", "C", 0.1)], "note_id string, code string, y_proba double")
    assert rows(pr.predict_default(scored), "code", "y_pred") == [("A", 0), ("B", 1), ("C", 0)]
    shown = pr.predict_threshold(scored, 0.5)
    assert rows(shown) == [("n", "A", 0.5), ("n", "B", 0.5)]
    dictionary = spark.createDataFrame([("A", "Alpha")], "code_3char string, description string")
    assert rows(pr.describe(shown, dictionary), "code", "description") == [("A", "Alpha"), ("B", "—")]
    notes = spark.createDataFrame([("n", "hello"), ("m", "there")], "note_id string, note_text string")
    answers = {r.note_id: r for r in pr.responses(pr.describe(shown, dictionary, ""), notes, "patient", 3).collect()}
    assert [p.code for p in answers["n"].predictions] == ["A", "B"] and answers["m"].predictions == []
    assert answers["n"].note_length == 5
