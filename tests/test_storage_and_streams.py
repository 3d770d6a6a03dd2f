"""Sources, sinks, generation, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartloom.operators import evaluation as ev
from chartloom.operators import features as ft
from chartloom.operators import generation as gn
from chartloom.operators import ovr
from chartloom.plans import workflows as wf
from chartloom.plans.writers import template_writer
from chartloom.session import scratch_root
from chartloom.sources import commits as cm
from chartloom.sources import landing as ld
from chartloom.sources import paths as ph
from chartloom.sources import results as rs
from chartloom.sources.notestore import LABELS_SCHEMA, NOTES_SCHEMA, NoteStore, read_backup, write_backup
from chartloom.streaming import latest as lt
from chartloom.streaming import scoring as sc

T = dt.datetime


def note(i, patient="p", strategy="multilabel", when=T(2026, 1, 1), text="note text here"):
    return (f"n{i}", "r1", patient, strategy, "v1", "m", when, text, ["A01"], None, None, 1, None, "STOP")


def test_landing_keeps_codes_and_quoted_newlines(spark, tmp_path):
    folder = tmp_path / "synthea" / "v1"
    folder.mkdir(parents=True)
    for file in ld.RECORD_FILES.values():
        (folder / file).write_text("ID\n1\n")
    (folder / "conditions.csv").write_text('PATIENT,START,STOP,ENCOUNTER,CODE,DESCRIPTION\np,2020-01-02,,e,0012,"two\nlines, ""quoted"""\n')
    row = ld.land_tables(spark, str(tmp_path), "v1")["conditions"].first()
    assert (row.CODE, row.DESCRIPTION, row.STOP, str(row.START)) == ("0012", 'two\nlines, "quoted"', None, "2020-01-02")
    assert spark.table("conditions").count() == 1
    (folder / "patients.csv").unlink()
    (folder / "observations.csv").unlink()
    with pytest.raises(FileNotFoundError, match="patients.csv, observations.csv"):
        ld.land_tables(spark, str(tmp_path), "v1")


def test_newest_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ph.newest_run(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        ph.newest_run(spark, str(tmp_path))
    for name in ("2026_01_02", "2026_01_10"):
        (tmp_path / name).mkdir()
    assert ph.newest_run(spark, str(tmp_path)).endswith("2026_01_10")


def test_vocabulary_files_are_unquoted_and_replaced(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    with pytest.raises(FileNotFoundError, match="CONCEPT.csv, CONCEPT_RELATIONSHIP.csv"):
        ld.load_vocabularies(spark, str(source), out)
    (source / "CONCEPT.csv").write_text('concept_id\tconcept_name\tvocabulary_id\tconcept_code\tstandard_concept\n1\tso-called "x\tSNOMED\t007\tS\n')
    (source / "CONCEPT_RELATIONSHIP.csv").write_text("concept_id_1\tconcept_id_2\trelationship_id\n1\t2\tMapped from\n")
    assert not ph.exists(spark, ld.load_vocabularies(spark, str(source), out, dry_run=True)["concept"])
    for _ in range(2):
        written = ld.load_vocabularies(spark, str(source), out)
    row = spark.read.parquet(written["concept"]).collect()
    assert [(r.concept_id, r.concept_name, r.concept_code) for r in row] == [(1, 'so-called "x', "007")]


def test_note_store(spark, tmp_path, caplog):
    store = NoteStore(spark, str(tmp_path / "store"))
    store.ensure_tables()
    store.ensure_tables()
    assert store.notes().count() == 0 and store.labels().count() == 0
    notes = spark.createDataFrame([note(1), note(2, when=T(2026, 1, 2))], NOTES_SCHEMA)
    labels = spark.createDataFrame([("n1", "A01", None, True), ("unseen", "A01", None, False)], LABELS_SCHEMA)
    store.append(notes.drop("encounter_id"), labels)
    assert store.notes().count() == 2 and [r.note_id for r in store.labels().collect()] == ["n1"]
    pruned = store.notes().where("generated_date = DATE'2026-01-02'")
    assert pruned.count() == 1 and "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().executedPlan().toString()
    store.append(notes.where("false"), labels.where("false"))
    assert "no rows to load" in caplog.text
    with pytest.raises(Exception, match="must not be null"):
        store.append(notes.withColumn("model", F.lit(None).cast("string")), labels)
    store.register_views()
    assert spark.table("notes_labels_clean_3char").count() == 1
    described = {(r.table_name, r.column_name): r for r in store.describe().collect()}
    assert described["notes_synth", "labels"].mode == "REPEATED"
    assert described["notes_synth", "note_id"].mode == "REQUIRED" and described["notes_synth", "note_id"].n_rows == 2
    write_backup(notes.drop("encounter_id"), str(tmp_path / "backup"))
    assert read_backup(spark, str(tmp_path / "backup")).where("encounter_id IS NULL").count() == 2


def test_a_failed_append_changes_nothing(spark, tmp_path):
    store = NoteStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.notes()
    store.ensure_tables()
    notes = spark.createDataFrame([note(1)], NOTES_SCHEMA)
    labels = spark.createDataFrame([("n1", "A01", None, True)], LABELS_SCHEMA)
    store.append(notes, labels)
    before = store.notes(), store.labels()
    # Labels of n2 are written, its note then fails: neither is seen, though files are there.
    more = labels.withColumn("note_id", F.explode(F.array(F.lit("n2"), F.lit("n1"))))
    with pytest.raises(Exception, match="must not be null"):
        store.append(notes.withColumns({"note_id": F.lit("n2"), "note_text": F.lit(None).cast("string")}), more)
    assert len(list((tmp_path / "notes_labels").glob("run=*"))) == 2
    assert store.notes().count() == 1 and store.labels().count() == 1
    store.append(notes.withColumn("note_id", F.lit("n2")), more)
    assert sorted(r.note_id for r in store.labels().collect()) == ["n1", "n1", "n2"]
    assert [frame.count() for frame in before] == [1, 1]  # opened before, still as it was
    # A run may have notes and no labels.
    store.append(notes.withColumn("note_id", F.lit("n3")), labels.where("false"))
    assert store.notes().count() == 3 and store.labels().count() == 3


def test_a_commit_in_between_is_kept(spark, tmp_path):
    root, tries = str(tmp_path), []

    def add(state):
        if not tries:  # another writer commits after this one has read the state
            tries.append(1)
            cm.publish(spark, root, lambda other: {"seen": [*other.get("seen", []), "other"]})
        return {"seen": [*state.get("seen", []), "own"]}

    assert cm.latest(spark, root) == (0, {})
    assert cm.publish(spark, root, add) == 2
    assert cm.latest(spark, root) == (2, {"seen": ["other", "own"]})
    for _ in range(9):
        cm.publish(spark, root, lambda state: state)
    assert cm.latest(spark, root)[0] == 11  # by number, not by name
    assert not [f for f in (tmp_path / "_commits").iterdir() if f.suffix not in (".json", ".crc")]


def test_split_and_results_round_trip(spark, tmp_path):
    split = spark.createDataFrame([("a::b", "dev")], "key string, bucket string")
    path = str(tmp_path / "split")
    with pytest.raises(FileNotFoundError):
        rs.load_split(spark, path, "pairs")
    rs.save_split(split, path, "pairs")
    assert rs.load_split(spark, path, "pairs").collect() == split.collect()
    with pytest.raises(ValueError):
        rs.load_split(spark, path, "encounter_ids")
    with pytest.raises(ValueError):
        rs.save_split(split, path, "nope")

    oof = spark.createDataFrame([("n", 1, "A", 1, 0.7, 1), ("m", 2, "A", 0, 0.2, 0)], rs.OOF_SCHEMA)
    with pytest.raises(FileNotFoundError):
        rs.load_oof(spark, str(tmp_path / "oof"))
    rs.save_oof(oof, str(tmp_path / "oof"))
    loaded = rs.load_oof(spark, str(tmp_path / "oof"))
    sweep = ev.threshold_sweep(loaded)
    rs.save_thresholds(sweep, ev.best_threshold(sweep), ev.fold_summary(ev.fold_scores(loaded)), str(tmp_path / "t"), "3char")
    best = spark.read.json(str(tmp_path / "t" / "best")).first()
    assert best.best_for_micro_f1.threshold == 0.25 and best.rollup == "3char"
    assert spark.read.parquet(str(tmp_path / "t" / "sweep")).count() == 17
    rs.save_per_code_stats(ev.per_code_stats(loaded), str(tmp_path / "stats"))
    assert spark.read.csv(str(tmp_path / "stats"), header=True).first().code == "A"
    (tmp_path / "codes.csv").write_text('code_3char,description\nJ20,"Acute, bronchitis"\n')
    assert rs.read_dictionary(spark, str(tmp_path / "codes.csv")).first().description == "Acute, bronchitis"
    assert rs.read_dictionary(spark, str(tmp_path / "none.csv")).isEmpty()


def test_retry_only_on_transient_errors():
    calls, waits = [], []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise ConnectionError("busy")
        return {"text": "ok"}

    assert gn.call_with_retry(flaky, "p", waits.append)["text"] == "ok"
    assert len(calls) == 3 and waits == [2.0, 2.0]

    def always(error):
        def call(prompt):
            calls.append(prompt)
            raise error

        return call

    for error, expected in ((TimeoutError("slow"), 3), (ValueError("bad"), 1)):
        calls.clear()
        with pytest.raises(type(error)):
            gn.call_with_retry(always(error), "p", waits.append)
        assert len(calls) == expected


def test_generation_run_records_failures_and_stores_the_rest(spark, tmp_path):
    schema = (
        "patient_id string, icd10_code string, icd10_description string, start_date date, stop_date date, "
        "snomed_code string, snomed_description string, position int"
    )
    rows = [(p, c, f"about {c}", None, None, "1", "s", i) for p in ("a", "b") for i, c in enumerate(("J20", "M17"), 1)]
    conditions = spark.createDataFrame(rows, schema)

    def sometimes():
        write = template_writer()

        def call(prompt):
            if prompt.startswith("Write a hospital discharge summary for an admission"):
                raise ValueError("refused")
            return write(prompt)

        return call

    run = wf.write_patient_notes(conditions, "r9", sometimes, pause=0, parallelism=2)
    store = NoteStore(spark, str(tmp_path))
    store.ensure_tables()
    store.append(run.notes, run.labels)
    assert sorted(r.note_id for r in store.notes().collect()) == ["r9_a_multilabel", "r9_b_multilabel"]
    assert store.labels().count() == 4 and store.labels().where("is_primary").isEmpty()
    assert {(r.patient_id, r.strategy, r.error) for r in run.failures.collect()} == {("a", "primary_dx", "refused"), ("b", "primary_dx", "refused")}
    good = wf.write_patient_notes(conditions, "r10", template_writer, ["primary_dx"], pause=0)
    assert {r.primary_code for r in good.notes.collect()} == {"J20"}
    assert sorted((r.note_id, r.icd10_code) for r in good.labels.where("is_primary").collect()) == [("r10_a_primary_dx", "J20"), ("r10_b_primary_dx", "J20")]
    encounters = conditions.withColumn("encounter_id", F.concat(F.lit("e"), "patient_id"))
    notes = wf.write_encounter_notes(encounters, "r11", template_writer, pause=0).notes.collect()
    assert {(n.note_id, n.encounter_id, n.primary_code, tuple(n.labels)) for n in notes} == {
        ("r11_ea_encounter", "ea", None, ("J20", "M17")), ("r11_eb_encounter", "eb", None, ("J20", "M17")),
    }


def test_latest_stream_picks_up_later_files(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    schema = spark.createDataFrame([], NOTES_SCHEMA).schema
    assert lt.read_latest(spark, out).isEmpty()
    first = [note(1), note(2, patient="q"), note(3, when=T(2025, 1, 1))]
    spark.createDataFrame(first, NOTES_SCHEMA).write.mode("append").json(feed)
    lt.follow_latest(spark, feed, schema, out).awaitTermination()
    assert sorted(r.note_id for r in lt.read_latest(spark, out).collect()) == ["n1", "n2"]
    # A later, an equally late and an older (late-arriving) note.
    second = [note(4, when=T(2026, 2, 1)), note(5, patient="q"), note(6, patient="q", when=T(2024, 1, 1))]
    spark.createDataFrame(second, NOTES_SCHEMA).write.mode("append").json(feed)
    lt.follow_latest(spark, feed, schema, out).awaitTermination()
    assert sorted(r.note_id for r in lt.read_latest(spark, out).collect()) == ["n4", "n5"]


def test_latest_stream_is_compacted(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    schema = spark.createDataFrame([], NOTES_SCHEMA).schema
    expected = {}
    for i in range(5):
        arriving = [note(i, patient=f"p{i % 2}", when=T(2026, 1, 1 + (i if i != 4 else 0))), note(f"once{i}", patient=f"q{i}")]
        for row in arriving:
            expected[row[2]] = max(expected.get(row[2], row), row, key=lambda r: (r[6], r[0]))
        spark.createDataFrame(arriving, NOTES_SCHEMA).coalesce(1).write.mode("append").json(feed)
        lt.follow_latest(spark, feed, schema, out, compact_every=2).awaitTermination()
        found = {r.patient_id: r.note_id for r in lt.read_latest(spark, out).collect()}
        assert found == {patient: row[0] for patient, row in expected.items()}
    through = cm.latest(spark, out)[1]["through"]
    folders = lt.state_folders(spark, out)
    batches = [int(f.rsplit("=", 1)[1]) for f in folders[1:]]
    assert "/snapshots/" in folders[0] and len(batches) < 2 and all(b > through for b in batches)
    read = lt.read_latest(spark, out).inputFiles()
    assert read and all(any(folder in file for folder in folders) for file in read)


def test_scoring_stream_scores_each_arrival_once(spark, tmp_path):
    notes = spark.createDataFrame(
        [(str(i), "cough and fever today" if i % 2 else "knee pain and gait trouble") for i in range(20)], "note_id string, note_text string"
    )
    labels = notes.select("note_id", F.when(F.col("note_text").startswith("cough"), "J20").otherwise("M17").alias("label_code"))
    model = ovr.fit(notes, labels, labels.select("label_code").distinct())
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    assert sc.read_predictions(spark, out).isEmpty()
    known = tmp_path / "dictionary.csv"
    arrivals = [[("x", "a cough and fever"), ("short", "cough")], [("y", "gait trouble and knee pain")]]
    # The dictionary is replaced between the batches: each is described by the one of its time.
    tables = ["code_3char,description\nJ20,bronchitis\n", "code_3char,description\nM17,knee\n"]
    for batch, table in zip(arrivals, tables):
        known.write_text(table)
        spark.createDataFrame(batch, "note_id string, note_text string").write.mode("append").json(feed)
        stream = spark.readStream.schema("note_id string, note_text string").json(feed)
        sc.score_stream(stream, model, out, dictionary=lambda s: rs.read_dictionary(s, str(known))).awaitTermination()
    answers = {r.note_id: [(p.code, p.description) for p in r.predictions] for r in sc.read_responses(spark, out).collect()}
    assert answers == {"x": [("J20", "bronchitis")], "y": [("M17", "knee")]}
    bare = str(tmp_path / "bare")
    sc.score_stream(spark.readStream.schema("note_id string, note_text string").json(feed), model, bare).awaitTermination()
    assert {p.description for r in sc.read_responses(spark, bare).collect() for p in r.predictions} == {""}
    assert sorted((r.note_id, r.code) for r in sc.read_predictions(spark, out).collect()) == [("x", "J20"), ("y", "M17")]


def test_cluster_sessions_need_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn", "applicationId": "x"})()

    with pytest.raises(RuntimeError):
        scratch_root(Session())
