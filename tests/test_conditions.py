"""Terminology, cohorts, primary picks, prompts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartloom.functions import codes as cd
from chartloom.functions import keys as ks
from chartloom.operators import cohort as co
from chartloom.operators import picker as pk
from chartloom.operators import prompts as pm
from chartloom.operators import ranking as rk
from chartloom.operators import terminology as tm
from chartloom.operators.joins import hot_keys
from chartloom.plans import workflows as wf
from chartloom.session import DEFAULTS

D = dt.date
CONDITION_SCHEMA = (
    "patient_id string, icd10_code string, icd10_description string, start_date date, stop_date date, "
    "snomed_code string, snomed_description string, position int"
)


def conditions(spark, rows):
    full = [(p, c, d, s, None, "1", "x", i) for p, c, d, s, i in rows]
    return spark.createDataFrame(full, CONDITION_SCHEMA)


@pytest.fixture
def terminology(spark):
    concept = spark.createDataFrame(
        [
            (1, "0012", "a", "SNOMED", "S"),
            (2, "77", "b", "SNOMED", None),
            (3, "88", "c", "SNOMED", "S"),
            (11, "A01.0", "x", "ICD10CM", None),
            (12, "B02", "y", "ICD10CM", None),
        ],
        "concept_id long, concept_code string, concept_name string, vocabulary_id string, standard_concept string",
    )
    edges = spark.createDataFrame(
        [(1, 11, "Mapped from"), (1, 12, "Mapped from"), (2, 11, "Mapped from"), (12, 1, "Maps to")],
        "concept_id_1 long, concept_id_2 long, relationship_id string",
    )
    source = spark.createDataFrame(
        [("p", "e", D(2020, 1, 1), None, "0012", "a"), ("p", "e", D(2020, 1, 1), None, "0012", "a")]
        + [("p", "e", None, None, code, "z") for code in ("77", "88", "99")],
        "PATIENT string, ENCOUNTER string, START date, STOP date, CODE string, DESCRIPTION string",
    )
    return source, concept, edges


def test_mapping_fans_out_keeps_duplicates_and_drops_unmapped(terminology, rows):
    assert rows(tm.billable_conditions(*terminology), "snomed_code", "icd10_code") == [
        ("0012", "A01.0"), ("0012", "A01.0"), ("0012", "B02"), ("0012", "B02"),
    ]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", DEFAULTS["spark.sql.autoBroadcastJoinThreshold"])


def test_salted_mapping_equals_broadcast_mapping(spark, terminology, rows, no_broadcast):
    salted = tm.billable_conditions(*terminology, salts=3)
    assert "Broadcast" not in salted._jdf.queryExecution().executedPlan().toString()
    found = rows(salted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")
    assert found == rows(tm.billable_conditions(*terminology))


def _many_conditions(spark, n=6000):
    """A third of all rows has one code, the rest 500 codes."""
    return spark.range(n).select(
        F.concat(F.lit("p"), F.col("id") % 700).alias("PATIENT"),
        F.col("id").cast("string").alias("ENCOUNTER"),
        F.lit(None).cast("date").alias("START"),
        F.lit(None).cast("date").alias("STOP"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("CODE"),
        F.lit("d").alias("DESCRIPTION"),
    )


def test_only_the_hot_code_is_spread(spark, no_broadcast):
    codes = ["hot"] + [f"c{i}" for i in range(500)]
    crosswalk = spark.createDataFrame([(c, f"I{i}") for i, c in enumerate(codes)], "snomed_code string, icd10_code string")
    facts = _many_conditions(spark).select(
        F.col("PATIENT").alias("patient_id"), F.col("ENCOUNTER").alias("encounter_id"),
        F.col("START").alias("condition_start_date"), F.col("CODE").alias("snomed_code"),
    )
    assert facts.select(hot_keys(facts, "snomed_code")).first()[0] == ["hot"]
    joined = tm._salted_join(facts, crosswalk, "snomed_code", 8)
    assert joined.count() == 6000
    assert joined.exceptAll(facts.join(crosswalk, "snomed_code").select(*joined.columns)).isEmpty()
    empty = facts.where("false")
    assert tm._salted_join(empty, crosswalk, "snomed_code", 8).isEmpty()


def test_notes_of_patients_take_one_shuffle(spark):
    # Rows of a query, because the engine knows their size and broadcasts them.
    concept = spark.sql(
        "SELECT * FROM VALUES (1L, '0012', 'a', 'SNOMED', 'S'), (3L, '88', 'c', 'SNOMED', 'S'), (11L, 'A01.0', 'x', 'ICD10CM', NULL), "
        "(12L, 'B02', 'y', 'ICD10CM', NULL), (13L, 'C03', 'z', 'ICD10CM', NULL) "
        "AS t(concept_id, concept_code, concept_name, vocabulary_id, standard_concept)"
    )
    edges = spark.sql(
        "SELECT * FROM VALUES (1L, 11L, 'Mapped from'), (1L, 12L, 'Mapped from'), (3L, 13L, 'Mapped from') "
        "AS t(concept_id_1, concept_id_2, relationship_id)"
    )
    found = [
        (f"p{i % 7}" if i % 5 else None, f"e{i}", dt.date(2020, 1, 1 + i % 28), None, ("0012", "77", "88")[i % 3], f"d{i % 3}")
        for i in range(120)
    ]
    facts = spark.createDataFrame(found, "PATIENT string, ENCOUNTER string, START date, STOP date, CODE string, DESCRIPTION string")
    prompts = []
    for together in ("patient_id", None):
        billable = tm.billable_conditions(facts, concept, edges, together=together)
        capped = co.cap_conditions(co.dedup_conditions(billable, co.PATIENT_KEY), co.PATIENT_KEY, 2)
        prompts.append(wf.patient_prompts(capped, ks.PATIENT_STRATEGIES))
    shuffles = [p._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for p in prompts]
    assert shuffles == [1, 2]
    a, b = (sorted(map(str, p.collect())) for p in prompts)
    assert a == b and len(a) == 14


def test_building_the_mapping_runs_no_job(spark, terminology):
    spark.sparkContext.setJobGroup("mapping-plan", "no job may run")
    tm.billable_conditions(*terminology)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("mapping-plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize(
    "code, weight", [("K02.1", 4), ("K06", 4), ("K21", 4), ("K00", 0), ("k1", 0), ("D49", 3), ("D64", 3), ("", 1), ("X", 1), ("I", 4), ("IA", 1), ("U07", 1)]
)
def test_chapter_weight(spark, code, weight):
    # The second character alone decides: K0x and K1x are dental, K2x..K9x are not.
    expected = 0 if code[:2].upper() in ("K0", "K1") else weight
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(cd.chapter_weight(F.col("c"))).first()[0] == expected


def test_scores_add_penalties_and_bonus(spark):
    df = spark.createDataFrame(
        [("J20.9", "Acute bronchitis, unspecified"), ("S93.491", "Personal history of sprain"), ("z12", "x"), ("M17", "OTHER SPECIFIED")],
        "icd10_code string, icd10_description string",
    )
    assert [r.score for r in pk.score_conditions(df).collect()] == [4 - 2 + 1, 4 - 4 + 1, -100, 1 - 2]


def test_primary_ties_go_to_latest_then_first_listed(spark, rows):
    df = conditions(
        spark,
        [
            ("a", "J20", "x", D(2020, 1, 1), 2), ("a", "I10", "x", D(2020, 1, 2), 1),
            ("b", "I10", "x", D(2020, 1, 1), 2), ("b", "J20", "x", D(2020, 1, 1), 1),
            ("c", "Z59", "x", None, 1), ("c", "Z60", "x", None, 2),
            ("d", "I10", "x", None, 2), ("d", "J20", "x", D(1900, 1, 1), 1),
        ],
    )
    assert rows(pk.pick_primary(df, ["patient_id"]), "patient_id", "primary_code") == [
        ("a", "I10"), ("b", "J20"), ("c", "Z59"), ("d", "J20"),
    ]


def test_prompts(spark, rows):
    df = conditions(spark, [("a", "I10", "Hypertension", D(2020, 1, 2), 1), ("a", "M17", "Knee {x}", None, 2), ("b", "J20", "Bronchitis", None, 1)])
    multi = {r.patient_id: r.prompt for r in pm.multilabel_prompts(df, ["patient_id"], "<{conditions_block}>").collect()}
    assert multi["a"] == "<- I10 (2020-01-02): Hypertension\n- M17 (unknown date): Knee {x}>"
    both = {r.patient_id: r.prompt for r in pm.primary_dx_prompts(df, ["patient_id"], "{primary_condition}|{secondary_block}").collect()}
    assert both["a"] == "Hypertension (ICD-10: I10)|- M17 (unknown date): Knee {x}"
    assert both["b"] == "Bronchitis (ICD-10: J20)|- (none)"


def test_dedup_and_cap(spark, rows):
    billable = spark.createDataFrame(
        [
            ("p", "e1", D(2020, 1, 5), D(2020, 2, 1), "1", "s", "A01", "x"), ("p", "e2", D(2020, 1, 1), D(2020, 3, 1), "2", "s", "A01", "w"),
            ("p", "e1", None, None, "1", "s", "B01", "x"), ("p", "e1", D(2020, 1, 1), None, "1", "s", "Z01", "x"), ("q", "e3", None, None, "1", "s", "z01", "x"),
        ],
        "patient_id string, encounter_id string, condition_start_date date, condition_stop_date date, snomed_code string, snomed_description string, icd10_code string, icd10_description string",
    )
    deduped = co.dedup_conditions(billable, ["patient_id"])
    one = deduped.where("icd10_code = 'A01'").first()
    assert (one.start_date, one.stop_date, one.icd10_description) == (D(2020, 1, 1), D(2020, 3, 1), "w")
    capped = co.cap_conditions(deduped.where("patient_id = 'p'"), ["patient_id"], 2)
    assert rows(capped, "position", "icd10_code") == [(1, "A01"), (2, "Z01")]  # equal starts by code, null start last
    assert rows(co.eligible_patients(billable, 3)) == [("p", 3)]
    assert rows(co.eligible_encounters(billable, 2)) == [("e1", "p", 2)]
    assert rows(co.eligible_encounters(billable, 1)) == [("e1", "p", 2), ("e2", "p", 1), ("e3", "q", 1)]


def test_hash_rank_equals_global_sort(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"))
    from pyspark.sql import Window

    ranked = rk.with_hash_rank(df, "k", group="g", seed=5, across_groups=True)
    hashed = F.md5(F.concat(F.lit("5:"), "k"))
    expected = df.withColumn("expected", F.row_number().over(Window.orderBy("g", hashed)))
    assert ranked.join(expected, "k").where("hash_rank <> expected").count() == 0
    large = rk.hash_sample(df, "k", df.agg(F.lit(100)).scalar())
    assert {r.k for r in large.collect()} == {r.k for r in rk.hash_sample(df, "k", 100).collect()}


def test_pool_sizes(spark):
    patients = spark.range(500).select(F.col("id").cast("string").alias("patient_id"))
    nobody = patients.where("false")
    assert co.patient_pool(patients, 40).count() == 40
    assert co.patient_pool(patients, 40, exclude=nobody).exceptAll(co.patient_pool(patients, 40)).isEmpty()
    run = patients.where("patient_id < 3")
    allowed = co.patient_pool(patients, 40, include=run)
    assert allowed.count() <= 3 and allowed.join(run, "patient_id", "left_anti").isEmpty()


def test_ids(spark):
    df = spark.createDataFrame([("r1_a_b_primary_dx",), ("r1_x_multilabel",), ("r1_x_other",), ("nounderscore",)], "id string")
    pairs = [r[0] for r in df.select(ks.pair_from_note_id(F.col("id"))).collect()]
    assert pairs == ["a_b::primary_dx", "x::multilabel", None, None]


def test_sample_ties_are_settled_by_the_columns_named(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "c"), ("k", "a")], "k string, t string")
    small = rk.hash_sample(df, "k", 1, ties=["t"])
    large = rk.hash_sample(df, "k", df.agg(F.lit(1)).scalar(), ties=["t"])
    assert small.first().t == large.first().t == "a"
