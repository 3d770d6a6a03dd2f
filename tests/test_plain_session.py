"""Model fitting in a session whose pandas settings are Spark's own."""

import pytest

from chartloom.operators import ovr

SETTING = "spark.sql.execution.arrow.pyspark.enabled"


@pytest.fixture
def plain(spark):
    before = spark.conf.get(SETTING)
    spark.conf.set(SETTING, "false")
    yield spark
    spark.conf.set(SETTING, before)


def test_fit_needs_no_session_setting_and_says_what_converged(plain):
    words = ("fever cough fatigue", "fracture of arm", "fever rash", "arm pain fracture", "cough cold fever", "broken arm")
    notes = plain.createDataFrame([(str(i), f"{t} patient note number") for i, t in enumerate(words * 3)], "note_id string, note_text string")
    labels = plain.createDataFrame(
        [(str(i), "J00" if i % 2 == 0 else "S42") for i in range(18)], "note_id string, label_code string"
    )
    vocab = labels.select("label_code").distinct()
    model = ovr.fit(notes, labels, vocab)
    assert model.info["not_converged"] == []
    assert {r.label_code for r in model.coefficients.collect()} == {"J00", "S42"}


def test_gradient_is_the_same_over_few_and_many_partitions(spark):
    import numpy as np

    def evaluate(parts):
        rows = spark.range(200).selectExpr(
            "cast(id as string) note_id", "array(cast(id % 7 as int), 7 + cast(id % 3 as int)) indices",
            "array(0.5D, 0.25D) values", "array(if(id % 2 = 0, 'a', 'b')) label_codes",
        )
        packed = ovr.pack(rows.repartition(parts), ["a", "b"], np.arange(10))
        packed = packed.repartition(parts)
        weights = np.full((2, 11), 0.1)
        ones = np.ones(2)
        return ovr._gradient_pass(spark, packed, np.arange(2), weights, ones, ones, packed.rdd.getNumPartitions())

    (few_loss, few), (many_loss, many) = evaluate(2), evaluate(300)
    assert np.allclose(few, many) and np.allclose(few_loss, many_loss)


def test_split_facts_and_migration_of_old_ids(spark, tmp_path):
    from chartloom.sources import results as rs

    old = [("r1_p1_multilabel", "dev"), ("r2_p1_multilabel", "dev"), ("r1_p_2_primary_dx", "test"), ("odd", "dev")]
    legacy = spark.createDataFrame(old, "note_id string, bucket string")
    split = rs.migrate_legacy_split(legacy)
    assert sorted(map(tuple, split.collect())) == [("p1::multilabel", "dev"), ("p_2::primary_dx", "test")]
    path = str(tmp_path / "split")
    rs.save_split(split, path, "pairs", seed=42, test_fraction=0.2, rollup="3char")
    assert tuple(rs.load_split_facts(spark, path).first()) == ("pairs", 42, 0.2, "3char")
    assert rs.load_split(spark, path, "pairs").count() == 2
    both = legacy.unionByName(spark.createDataFrame([("r3_p1_multilabel", "test")], legacy.schema))
    with pytest.raises(ValueError):
        rs.migrate_legacy_split(both)
