"""What the driver and the disk are given, whatever the number of tasks or prompts."""

import inspect

import numpy as np
from pyspark.sql import functions as F

from chartloom.operators import generation as gn
from chartloom.operators import ovr
from chartloom.operators import prompts as pm
from chartloom.plans import workflows as wf


def test_driver_takes_one_sum_of_a_large_model(spark, monkeypatch):
    rows = spark.range(64, numPartitions=8).select(
        F.array((F.col("id") % 10).cast("int")).alias("indices"),
        F.array(F.lit(1.0)).alias("values"),
        F.array(F.when(F.col("id") % 3 == 0, "a").otherwise("b")).alias("label_codes"),
    )
    packed = ovr.pack(rows, ["a", "b"], np.arange(10)).repartition(8)
    args = np.arange(2), np.ones((2, 11)), np.ones(2), np.ones(2), 8
    few = ovr._gradient_pass(spark, packed, *args)
    monkeypatch.setattr(ovr, "MAX_DRIVER_ENTRIES", 20)
    taken, plain = [], type(packed).toArrow

    def seen(df):
        table = plain(df)
        taken.append(sum(len(p.as_py()) for p in table["payload"]))
        return table

    monkeypatch.setattr(type(packed), "toArrow", seen)
    many = ovr._gradient_pass(spark, packed, *args)
    assert taken == [2 * 12 * 8]
    for a, b in zip(few, many, strict=True):
        np.testing.assert_allclose(a, b, atol=1e-12)


def test_no_more_than_two_solvers_at_once_unless_asked():
    assert inspect.signature(wf.cross_validation).parameters["parallelism"].default == 2


def test_a_task_keeps_its_answers_in_one_file(spark, tmp_path):
    prompts = spark.range(200, numPartitions=4).select(F.concat(F.lit("q"), "id").alias("prompt"))
    ledger = tmp_path / "ledger"
    writer = lambda: lambda prompt: {"text": prompt}
    assert gn.generate_notes(prompts, writer, pause=0, ledger=str(ledger)).where("note_text = prompt").count() == 200
    assert len([p for p in ledger.rglob("*") if p.is_file() and p.suffix in (".json", ".jsonl")]) == 4


def test_prompts_group_conditions_once(spark):
    schema = (
        "patient_id string, encounter_id string, position int, icd10_code string, icd10_description string, "
        "start_date date, stop_date date, snomed_code string, snomed_description string"
    )
    listed = [
        (p, f"e{p}", i + 1, code, None if i == 1 else f"disease {code}", None, None, "s", "d")
        for p in ("p1", "p2", None) for i, code in enumerate(["J10.0", None, "Z59.1", "K06.8"][: 1 + 3 * (p == "p2")])
    ]
    conditions = spark.createDataFrame(listed, schema)
    made = wf.patient_prompts(conditions, ["multilabel", "primary_dx"])
    plain = pm.multilabel_prompts(conditions, ["patient_id"]).select("patient_id", F.lit("multilabel").alias("strategy"), "prompt")
    focused = pm.primary_dx_prompts(conditions, ["patient_id"]).select("patient_id", F.lit("primary_dx").alias("strategy"), "prompt")
    expected = plain.unionByName(focused).where("patient_id IS NOT NULL")
    assert sorted(map(tuple, made.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    encounter = wf.encounter_prompts(conditions)
    assert [r.conditions[0].icd10_code for r in encounter.orderBy("patient_id").collect()] == ["J10.0", "J10.0"]
    for prompts in (made, encounter):
        plan = prompts._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_log_gives_back_whole_answers_to_a_later_try(tmp_path):
    key, torn = "ab" * 32, "cd" * 32
    log = gn.Log(gn.Ledger(str(tmp_path)), "c", 3)
    assert log.get(key) is None
    log.put(key, {"note_text": "é\n", "input_tokens": None})
    log.sink.write(b'{"key": "' + torn.encode())
    again = gn.Log(gn.Ledger(str(tmp_path)), "c", 3)
    again.put("ef" * 32, {"note_text": "b"})
    for reader in (log, again):
        assert reader.get(key) == {"note_text": "é\n", "input_tokens": None} and reader.get(torn) is None
    assert again.get("ef" * 32) == {"note_text": "b"}


def test_counting_words_of_a_large_batch_takes_little_memory():
    import tracemalloc

    import pyarrow as pa

    from chartloom.operators import ngrams as ng

    rng = np.random.default_rng(1)
    words = pa.array([f"w{i}" for i in range(50_000)])
    picked = words.take(pa.array(rng.integers(0, 50_000, 800_000)))
    batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(0, 800_001, 1_000, np.int32)), picked)], ["tokens"])
    tracemalloc.start()
    n = sum(int(ng.word_counts(part.column(0), 1, 2).tf.sum()) for part in ng.slices(batch, 0, ng.SLICE_WORDS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 800 * (1_000 + 999)
    # Slices of 400,000 tokens took more than this.
    assert peak < 25_000_000
