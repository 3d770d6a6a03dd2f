import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.llm import linear, quality, toxicity

SF_DIR = "/root/testdata/sf0.01"


def _auc(rows, label):
    pos = [r.score for r in rows if r[label] == 1]
    neg = [r.score for r in rows if r[label] == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


@pytest.mark.parametrize("module,label,least", [(quality, "quality", 0.98), (toxicity, "toxic", 0.8)])
def test_held_out_ranking(spark, module, label, least):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    scored = linear.report(module.score(docs, module.train(docs, labels)), module.THRESHOLD)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(crc32(str(r.doc_id).encode()) % 5 == 0 and r.predicted == (r.score >= module.THRESHOLD) for r in rows)
    assert _auc(rows, label) >= least


def test_labels_of_held_out_nulls_and_contradictions_are_not_learned(spark, documents):
    pairs = [(i, f"text {i}") for i in range(60)] + [(7, "text 7"), (None, "x"), (8, None)]
    table = [(i, i % 2) for i in range(40)] + [(1, 0), (2, None), (None, 1), (41, 7), (99, 1)]
    labels = spark.createDataFrame(table, "doc_id long, quality int")
    got = {r.doc_id: r for r in linear.training_texts(documents(pairs), labels, "quality", 1000).collect()}
    want = {i for i in range(40) if crc32(str(i).encode()) % 5 and i not in (1,)}
    assert set(got) == want and all(got[i].y == i % 2 for i in want)
    assert linear.training_texts(documents(pairs), labels, "quality", 5).count() == 5


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_inputs(spark, documents, module, label):
    labels = spark.createDataFrame([], f"doc_id long, {label} int")
    docs = documents([(1, None), (1, None), (2, ""), (None, "a " * 50_000), (3, "\n\n  \t"), (4, "words here")])
    got = module.score(docs, module.train(docs, labels)).collect()
    assert len(got) == 6 and all(0.0 <= r.score <= 1.0 for r in got)
    one = spark.createDataFrame([(4, 1), (2, 1)], f"doc_id long, {label} int")
    assert all(0.0 <= r.score <= 1.0 for r in module.score(docs, module.train(docs, one)).collect())
    assert module.score(documents([]), module.train(docs, labels)).count() == 0
    kept = linear.keep(docs, module.scorer(spark, module.train(docs, labels)), lambda s: s >= 0)
    assert kept.columns == docs.columns and kept.count() == 6


def test_swapping_groups_stops_a_group_from_counting():
    rng = random.Random(0)
    fill = "table chair window garden river mountain letter market".split()
    rows, y, swapped = [], [], []
    for i in range(400):
        toxic = i % 3 == 0
        words = rng.sample(fill, 4) + (["scumbag"] if toxic and rng.random() < 0.8 else [])
        # One group is named mostly in toxic texts.
        words.append("muslim" if toxic else rng.choice(["christian", "hindu", "river"]))
        text = " ".join(words)
        rows.append(toxicity.features(text))
        y.append(int(toxic))
        swapped.append(toxicity.swaps(text))
    y = np.array(y)

    def score(model, text):
        return linear.sigmoid(model[0][toxicity.features(text)].sum() + model[1])

    neutral = "a muslim wrote a letter in the garden"
    plain = toxicity.fit(rows, y, swapped, penalty=0.0)
    fair = toxicity.fit(rows, y, swapped)
    assert score(plain, neutral) > 0.5 > score(fair, neutral)
    assert score(fair, "scumbag table chair window") > score(fair, neutral)
    gap = abs(score(fair, neutral) - score(fair, neutral.replace("muslim", "christian")))
    assert gap < 0.05


def test_dual_descent_meets_the_optimality_conditions():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(40, 6, replace=False)) for _ in range(120)]
    y = np.array([int(np.isin(r, np.arange(12)).sum() >= 2) for r in rows])
    scale = np.zeros(linear.SIZE)
    scale[:40] = rng.normal(size=40)
    cost = 0.05
    w, b = quality.dual_descent(rows, y, scale, cost=cost, epochs=2000)
    sign = np.where(y == 1, 1.0, -1.0)
    top = cost * len(y) / (2 * np.bincount(y, minlength=2))[y]
    x = np.zeros((len(rows), 41))
    for i, r in enumerate(rows):
        x[i, r], x[i, 40] = scale[r], 1.0
    wb = np.append(w[:40], b)

    def objective(v):
        return v @ v / 2 + (top * np.maximum(0, 1 - sign * (x @ v))).sum()

    best = objective(wb)
    for _ in range(200):
        assert objective(wb + rng.normal(size=41) * 0.01) >= best - 1e-3


def test_held_out_rows_by_hash(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", linear.held_out(F.col("doc_id"))).collect()}
    assert got == {**{i: crc32(str(i).encode()) % 5 == 0 for i in range(50)}, None: True}


def test_swaps_are_sent_as_what_they_change():
    text = " ".join(["a muslim and a woman wrote", *(f"word{i}" for i in range(5000))])
    own, others = toxicity.features(text), toxicity.swaps(text)
    row = toxicity.coded(text)
    assert len(others) > 3 and len(row) < len(own) + 100 * len(others)
    features, pairs = toxicity.decoded(row)
    assert features.tolist() == own.tolist() and len(pairs) == len(others)
    for other, (lost, gained) in zip(others, pairs, strict=True):
        assert np.union1d(np.setdiff1d(own, lost), gained).tolist() == other.tolist()
    y, rows = np.array([0, 1] * 20), [own] * 40
    by_pairs = toxicity.fit(rows, y, [pairs] * 40, rounds=3)
    assert np.array_equal(by_pairs[0], toxicity.fit(rows, y, [others] * 40, rounds=3)[0])


def test_large_batches_are_judged_in_slices():
    import pyarrow as pa

    texts = [chr(97 + i) * 400_000 for i in range(9)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(11)), "text": pa.array(texts, pa.string())})
    parts = list(linear.kept_rows(batch, 1, lambda t: float(len(t) == 0 or t[0] != "c"), lambda s: s > 0.5))
    assert [i for p in parts for i in p.column(0).to_pylist()] == [0, 1, 3, 4, 5, 6, 7, 8, 9, 10]
    assert len(parts) >= 4
    assert max(sum(len(t or "") for t in p.column(1).to_pylist()) for p in parts) <= linear.SLICE_BYTES


def test_known_words_take_little_memory():
    import tracemalloc

    own = toxicity.Featurizer()
    words = [f"{'abcdefghij'[i % 10]}{chr(97 + i // 10 % 26)}word{chr(97 + i // 260)}x" for i in range(20_000)]
    assert own.of_words({"old"}).tolist() == sorted(set(toxicity.word_features("old")))
    assert own.of_words(set()).tolist() == []
    tracemalloc.start()
    found = own.of_words(set(words))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert found.tolist() == sorted({f for w in set(words) for f in toxicity.word_features(w)})
    # Lists of numbers took more than 250 bytes a word.
    assert held < 200 * len(set(words))
