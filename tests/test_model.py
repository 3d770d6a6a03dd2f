"""Features, the one-vs-rest solver, cross-validation."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chartloom.operators import dataset as ds
from chartloom.operators import evaluation as ev
from chartloom.operators import features as ft
from chartloom.operators import ngrams as ng
from chartloom.operators import ovr
from chartloom.plans import workflows as wf
from chartloom.sources import results as rs

TOPICS = {
    "J20": "acute cough bronchitis sputum airway wheeze",
    "I10": "blood pressure hypertension amlodipine elevated",
    "M17": "knee joint pain stiffness gait osteoarthritis",
}


def make_notes(n=90):
    rng = np.random.default_rng(3)
    notes, labels = [], []
    for i in range(n):
        codes = [c for c in TOPICS if rng.random() < 0.45] or ["J20"]
        words = [w for c in codes for w in rng.choice(TOPICS[c].split(), 4)] + list(rng.choice("the of and was a with".split(), 6))
        notes.append((f"n{i}", " ".join(rng.permutation(words))))
        labels += [(f"n{i}", c) for c in codes] + [(f"n{i}", "ALL")]
    return notes, labels


@pytest.fixture(scope="module")
def corpus(spark):
    notes, labels = make_notes()
    vocab = [(c,) for c in (*TOPICS, "ALL", "NONE")]
    return (
        spark.createDataFrame(notes, "note_id string, note_text string"),
        spark.createDataFrame(labels, "note_id string, label_code string"),
        spark.createDataFrame(vocab, "label_code string"),
    )


@pytest.fixture(scope="module")
def model(corpus):
    return ovr.fit(*corpus)


def python_counts(text, analyzer):
    if analyzer == "word":
        tokens = re.findall(r"\b\w\w+\b", text.lower())
        return Counter(tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])])
    found = Counter()
    for word in text.lower().split():
        padded = f" {word} "
        for n in (3, 4, 5):
            found.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return found


@pytest.mark.parametrize("block", ft.BLOCKS, ids=lambda b: b.name)
def test_term_counts_match_plain_python(spark, block):
    texts = ["A b  cc\t\tdd_1 ee ff.", "x", "", "Été über ÉTÉ naïve-co\nop", "one one one two", "𝒳y z w"]
    notes = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "note_id string, note_text string")
    found = {}
    for row in ft.term_counts(notes, block).collect():
        found.setdefault(row.note_id, {})[row.term] = row.tf
    for i, text in enumerate(texts):
        assert found.get(str(i), {}) == python_counts(text, block.name)


def test_only_text_and_vocabulary_counts_are_shuffled(corpus):
    plan = ft.document_frequencies(corpus[0], ft.CHAR)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    assert sorted(exchanges) == ["note_id", "term"]


def test_vocabulary_cut_is_totally_ordered(spark, rows):
    notes = spark.createDataFrame([("1", "bb aa cc dd"), ("2", "aa bb dd dd"), ("3", "bb ee")], "note_id string, note_text string")
    block = ft.Block("word", 1, 1, min_df=2, max_df=0.95, max_features=2)
    # bb is in every note; of aa (2 uses) and dd (3 uses) both fit; ids follow term order.
    assert rows(ft.vocabulary(notes, block), "term", "feature_id", "df", "cf") == [("aa", 0, 2, 2), ("dd", 1, 2, 3)]
    idf = {r.term: r.idf for r in ft.vocabulary(notes, block).collect()}
    assert idf["aa"] == pytest.approx(math.log(4 / 3) + 1)


def test_vectors_equal_rows_and_have_unit_blocks(corpus):
    notes = corpus[0]
    vocabularies = ft.fit_vocabularies(notes)
    listed = {}
    for r in ft.feature_rows(notes, vocabularies).collect():
        listed.setdefault(r.note_id, {})[r.feature_id] = r.weight
    for r in ft.feature_vectors(notes, vocabularies).collect():
        assert listed[r.note_id] == pytest.approx(dict(zip(r.indices, r.values)))
        assert sum(v * v for v in r["values"]) == pytest.approx(2.0)


def dense_problem(corpus, model, code):
    width = sum(b.max_features for b in ft.BLOCKS)
    truth = {r.note_id for r in corpus[1].where(F.col("label_code") == code).collect()}
    rows = ft.feature_vectors(corpus[0], model.vocabularies).collect()
    x = np.zeros((len(rows), width + 1))
    x[:, -1] = 1
    for i, r in enumerate(rows):
        x[i, r.indices] = r["values"]
    y = np.array([1.0 if r.note_id in truth else -1.0 for r in rows])
    s = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    return x, y, s


def newton(x, y, s, steps=60):
    used = np.flatnonzero(x.any(axis=0))
    a = x[:, used]
    w = np.zeros(len(used))
    for _ in range(steps):
        p = 1 / (1 + np.exp(y * (a @ w)))
        grad = w - a.T @ (s * y * p)
        hess = np.eye(len(used)) + (a.T * (s * p * (1 - p))) @ a
        w = w - np.linalg.solve(hess, grad)
    full = np.zeros(x.shape[1])
    full[used] = w
    return full


@pytest.mark.parametrize("code", list(TOPICS))
def test_fit_reaches_the_optimum_of_an_independent_solver(corpus, model, code):
    row = model.coefficients.where(F.col("label_code") == code).first()
    ours = np.array([*row.weights, row.intercept])
    x, y, s = dense_problem(corpus, model, code)
    best = newton(x, y, s)

    def objective(w):
        return 0.5 * w @ w + (s * np.logaddexp(0, -y * (x @ w))).sum()

    assert objective(ours) == pytest.approx(objective(best), abs=1e-5)
    assert np.abs(ours - best).max() < 2e-3


def test_constant_labels_predict_constants(corpus, model):
    scored = ovr.score_notes(corpus[0], model).groupBy("code").agg(F.min("y_proba").alias("lo"), F.max("y_proba").alias("hi"))
    found = {r.code: (r.lo, r.hi) for r in scored.collect()}
    assert found["ALL"] == (1.0, 1.0) and found["NONE"] == (0.0, 0.0)
    assert 0 < found["I10"][0] < found["I10"][1] < 1


def test_a_note_is_scored_by_the_task_that_makes_its_vector(corpus, model):
    scored = ovr.score_notes(corpus[0], model)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "MapInPandas" not in plan
    width = sum(b.max_features for b in ft.BLOCKS)
    apart = ovr.score_vectors(ft.feature_vectors(corpus[0], model.vocabularies), model.coefficients, width)
    found = {(r.note_id, r.code): r.y_proba for r in scored.collect()}
    assert found == {(r.note_id, r.code): pytest.approx(r.y_proba, abs=1e-12) for r in apart.collect()}
    kept = {(r.note_id, r.code): r.y_proba for r in ovr.score_notes(corpus[0], model, min_proba=0.5).collect()}
    assert kept == {k: p for k, p in found.items() if p >= 0.5} and 0 < len(kept) < len(found)


@pytest.mark.parametrize("count, low, high", [(ng.word_counts, 1, 2), (ng.char_counts, 3, 5)])
def test_known_terms_are_counted_alone_and_a_few_notes_at_a_time(monkeypatch, count, low, high):
    rng = np.random.default_rng(5)
    words = ["a", "", "bé", "abcab", "x" * 60, "caba"]
    tokens = pa.array([None, *([words[i] for i in rng.integers(0, 6, n)] for n in (0, 1, 40, 7, 12))], pa.list_(pa.string()))

    def rows(found):
        return list(zip(found.note.tolist(), found.terms.take(pa.array(found.term)).to_pylist(), found.tf.tolist()))

    whole = rows(count(tokens, low, high))
    monkeypatch.setattr(ng, "_CHUNK", 10)
    assert rows(count(tokens, low, high)) == whole
    known = sorted({term for _, term, _ in whole})[::2] + ["not there"]
    found = count(tokens, low, high, pa.array(known))
    assert sorted(rows(found)) == sorted(r for r in whole if r[1] in known)
    assert (np.diff(found.note * len(known) + found.term) > 0).all()


def test_fit_and_score_in_label_groups_equal_one_group(corpus, model, monkeypatch):
    monkeypatch.setattr(ovr, "MAX_GROUP_ENTRIES", 1)
    grouped = ovr.fit(*corpus)
    a = {(r.note_id, r.code): r.y_proba for r in ovr.score_notes(corpus[0], grouped).collect()}
    monkeypatch.undo()
    b = {(r.note_id, r.code): r.y_proba for r in ovr.score_notes(corpus[0], model).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 2e-3


def test_many_partitions_give_the_same_gradient(corpus, spark, monkeypatch):
    notes, labels, vocab = corpus
    vocabularies = ft.fit_vocabularies(notes)
    from chartloom.operators.labels import labels_per_note

    features = ovr._feature_ids(vocabularies, ft.BLOCKS)
    names = sorted(TOPICS)
    rows = labels_per_note(ft.feature_vectors(notes, vocabularies), labels)
    one = ovr.pack(rows, names, features)
    many = ovr.pack(rows, names, features).repartition(70)
    monkeypatch.setattr(ovr, "MAX_DRIVER_PARTIALS", 1)
    w = np.random.default_rng(0).normal(size=(3, len(features) + 1)) * 0.1
    args = np.arange(3), w, np.ones(3), np.full(3, 2.0)
    loss_one, grad_one = ovr._gradient_pass(spark, one, *args)
    loss_many, grad_many = ovr._gradient_pass(spark, many, *args)
    np.testing.assert_allclose(loss_one, loss_many)
    np.testing.assert_allclose(grad_one, grad_many, atol=1e-9)


def test_cross_validation_scores_every_note_once_without_seeing_it(corpus, spark):
    notes, labels, vocab = corpus
    vocab = vocab.where("label_code <> 'NONE'")
    data = ds.Dataset(notes, labels, vocab, spark.range(1))
    oof = wf.cross_validate(data, k=3).cache()
    assert oof.count() == 90 * 4 and oof.select("note_id", "code").distinct().count() == 90 * 4
    assert ev.micro_scores(oof.where("code <> 'ALL'")).first().micro_f1 > 0.9
    # Fold 1 again, with a model fitted from scratch on the other folds.
    held = oof.where("fold = 1").select("note_id").distinct()
    train_notes = notes.join(held, "note_id", "left_anti")
    train_labels = labels.join(held, "note_id", "left_anti")
    alone = ovr.score_notes(notes.join(held, "note_id", "left_semi"), ovr.fit(train_notes, train_labels, vocab))
    gap = oof.alias("a").join(alone.alias("b"), ["note_id", "code"]).select(F.max(F.abs(F.col("a.y_proba") - F.col("b.y_proba"))))
    assert gap.first()[0] < 2e-3


def test_model_store_round_trip(corpus, model, spark, tmp_path):
    models = str(tmp_path)
    assert rs.available_models(spark, models) == []
    with pytest.raises(FileNotFoundError):
        rs.load_named_model(spark, models, "patient")
    with pytest.raises(ValueError):
        rs.load_named_model(spark, models, "nope")
    rs.save_model(model, models, rs.MODEL_BUNDLES["patient"])
    assert rs.available_models(spark, models) == ["patient"]
    loaded = rs.load_named_model(spark, models, "patient")
    assert loaded.labels == model.labels and loaded.info == model.info
    # Saved over the path it is read from: both the old handle and the new one stay whole.
    rs.save_model(loaded, models, rs.MODEL_BUNDLES["patient"])
    again = rs.load_named_model(spark, models, "patient")
    assert again.coefficients.count() == loaded.coefficients.count() == model.coefficients.count()
    (tmp_path / rs.MODEL_BUNDLES["encounter"] / "half" / "vocabularies").mkdir(parents=True)  # a save that never finished
    assert rs.available_models(spark, models) == ["patient"]
    dictionary = rs.read_dictionary(spark, str(tmp_path / "none.csv"))
    one = corpus[0].limit(1)
    assert wf.predict(one, loaded, dictionary).collect() == wf.predict(one, model, dictionary).collect()
    table = wf.evaluate(loaded, ds.Dataset(corpus[0], corpus[1], corpus[2], spark.range(1)))
    assert ev.score_table(table).first().n_notes == 90
    thin = wf.evaluate_sparse(loaded, ds.Dataset(corpus[0], corpus[1], corpus[2], spark.range(1)))
    assert thin.rows.count() < table.count()
    for metric in (ev.score_table, ev.threshold_sweep):
        for few, all_cells in zip(metric(thin).orderBy("micro_f1").collect(), metric(table).orderBy("micro_f1").collect(), strict=True):
            assert tuple(few) == pytest.approx(tuple(all_cells))


def packed_rows(spark, n=400, n_features=60):
    """Rows that share a heavy direction and differ by light ones, and two labels that the light ones tell apart."""
    rng = np.random.default_rng(5)
    x = np.hstack([np.full((n, 1), 3.0), 3 + 0.2 * rng.standard_normal((n, 3)), 0.3 * rng.standard_normal((n, n_features - 4))])
    y = (x[:, 4:].sum(axis=1, keepdims=True) + rng.standard_normal((n, 2)) > [0.5, 2.5]).astype(int)
    rows = [(list(range(n_features)), r.tolist(), [c for c, has in zip("AB", own) if has]) for r, own in zip(x, y)]
    table = spark.createDataFrame(rows, "indices array<int>, values array<double>, label_codes array<string>")
    return x, y, ovr.pack(table.repartition(3), ["A", "B"], np.arange(n_features))


def test_heavy_directions_are_those_of_the_rows_squares(spark):
    x, _, packed = packed_rows(spark)
    whole = np.hstack([x, np.ones((len(x), 1))])
    directions, squares = ovr.main_directions(spark, packed, whole.shape[1])
    true = np.linalg.eigvalsh(whole.T @ whole)[::-1]
    assert squares[0] == pytest.approx(true[0], rel=1e-4)
    assert np.allclose(directions.T @ directions, np.eye(directions.shape[1]), atol=1e-9)
    assert (whole @ directions[:, 0]) @ (whole @ directions[:, 0]) == pytest.approx(true[0], rel=1e-4)


def test_fit_is_flattened_along_heavy_directions(spark, monkeypatch):
    x, y, packed = packed_rows(spark)
    n_features = x.shape[1]
    args = (spark, packed, ["A", "B"], {"A": int(y[:, 0].sum()), "B": int(y[:, 1].sum())}, len(x), np.arange(n_features), n_features)

    def fitted():
        coefficients, passes, unsettled = ovr.fit_packed(*args)
        rows = sorted(coefficients.collect())
        assert unsettled == []
        return np.array([[*r.weights, r.intercept] for r in rows]), passes

    flat, passes = fitted()
    monkeypatch.setattr(ovr, "_flattener", lambda *_: lambda gradient: gradient)
    plain, plain_passes = fitted()
    # Both are within a gradient of 1e-3 or little more of the one optimum, two passes for the directions included.
    assert np.abs(flat - plain).max() < 5e-3
    assert passes < plain_passes


def test_solver_remembers_enough_steps_for_a_wide_spectrum():
    bend = np.geomspace(1, 1e3, 40)
    pull = np.sqrt(bend)[None]

    def evaluate(ids, points):
        return 0.5 * (bend * points * points).sum(1) - (pull * points).sum(1), bend * points - pull

    found, evaluations, settled = ovr.minimise(evaluate, 1, 40, np.array([1e-6]))
    assert settled.all() and np.abs(found - pull / bend).max() < ovr.GRADIENT_FLOOR
    # 160 with eight steps of double precision.
    assert evaluations < 145


@pytest.mark.parametrize("n_features, size", [(300, 2), (70_000, 4)])
def test_packs_hold_narrow_positions_and_open_as_they_were(spark, n_features, size):
    rng = np.random.default_rng(2)
    x = rng.random((3, n_features)) + 0.1
    rows = [(list(range(n_features)), r.tolist(), ["A"]) for r in x]
    table = spark.createDataFrame(rows, "indices array<int>, values array<double>, label_codes array<string>")
    packs = ovr.pack(table.coalesce(1), ["A"], np.arange(n_features)).toArrow().combine_chunks().to_batches()[0]
    (n, indptr, touched, cols, vals, _, _), *others = ovr._packs(packs)
    assert n == 3 and not others and len(cols.to_pybytes()) == size * x.size
    found, opened = ovr._opened(indptr, touched, cols, vals)
    assert np.array_equal(found, np.arange(n_features)) and np.array_equal(opened, x)
