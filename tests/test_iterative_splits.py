import random
from collections import Counter

import pytest

from chartloom.operators import splits as sp

LABELS = "key string, label_code string"


def greedy(counts, n, turn):
    """One key after the other goes to the lowest fold, equal ones in turn."""
    counts, quota = list(counts), [0] * len(counts)
    for _ in range(n):
        f = min(range(len(counts)), key=lambda f: (counts[f], (f - turn) % len(counts)))
        counts[f] += 1
        quota[f] += 1
    return quota


def test_quotas_equal_dealing_one_by_one():
    r = random.Random(3)
    for _ in range(3000):
        k = r.randrange(1, 7)
        counts = [r.randrange(0, 12) for _ in range(k)]
        n, turn = r.randrange(0, 40), r.randrange(k)
        assert sp.level_quotas(counts, n, turn) == greedy(counts, n, turn)


def labelled(seed, n=1500):
    """Labels of very different size, some going together, a third of the keys with one and the same label."""
    r = random.Random(seed)
    names = [f"L{i:02d}" for i in range(25)]
    rows = set()
    for i in range(n):
        key = f"k{i}"
        own = set(r.choices(names, [1 / (j + 1) for j in range(25)], k=r.randrange(1, 5)))
        if i % 3 == 0:
            own.add("L00")
        if "L20" in own:
            own.add("L05")
        rows |= {(key, c) for c in own}
    return sorted(rows)


def spread(folds, rows, k):
    fold_of = {r.key: r.fold for r in folds.collect()}
    counts = {}
    for key, code in rows:
        counts.setdefault(code, Counter())[fold_of[key]] += 1
    return fold_of, {c: sum(abs(n[f] - sum(n.values()) / k) for f in range(1, k + 1)) for c, n in counts.items()}


@pytest.mark.parametrize("k", [5, 3])
def test_labels_are_spread_more_evenly_than_by_the_rarest_label_alone(spark, k):
    rows = labelled(1)
    labels = spark.createDataFrame(rows, LABELS)
    fold_of, own = spread(sp.iterative_folds(labels, k), rows, k)
    _, rarest = spread(sp.stratified_folds(labels, k), rows, k)
    assert set(fold_of) == {key for key, _ in rows} and set(fold_of.values()) == set(range(1, k + 1))
    assert sum(own.values()) < sum(rarest.values())
    # A label whose keys mostly come in its own turn is off by less than one key a fold.
    first = {min((sum(c == code for _, c in rows), code) for code in {c for q, c in rows if q == key})[1] for key in fold_of}
    sizes = Counter(c for _, c in rows)
    led = [c for c in first if own[c] <= k]
    assert len(led) >= 0.8 * len(first)
    assert all(own[c] <= max(rarest[c], k) for c in sizes)


def test_folds_do_not_depend_on_partitions(spark):
    rows = labelled(2, 300)
    one = sp.iterative_folds(spark.createDataFrame(rows, LABELS).repartition(1), 4)
    many = sp.iterative_folds(spark.createDataFrame(rows[::-1], LABELS).repartition(7), 4)
    assert sorted(one.collect()) == sorted(many.collect())


def test_a_label_counted_in_earlier_rounds_is_levelled(spark):
    # All keys of the rare label have the common one too; the common one's own keys make up for them.
    rows = [(f"a{i}", c) for i in range(7) for c in ("rare", "common")] + [(f"b{i}", "common") for i in range(13)]
    fold_of, own = spread(sp.iterative_folds(spark.createDataFrame(rows, LABELS), 5), rows, 5)
    assert own["common"] == 0 and sorted(Counter(fold_of.values()).values()) == [4] * 5


def test_fewer_keys_than_folds_and_none(spark):
    assert sp.iterative_folds(spark.createDataFrame([], LABELS), 5).count() == 0
    rows = [("x", "a"), ("y", "a"), ("y", "b")]
    folds = sp.iterative_folds(spark.createDataFrame(rows, LABELS), 5).collect()
    assert len(folds) == 2 and len({f.fold for f in folds}) == 2


def test_the_split_holds_one_fold_out(spark):
    rows = labelled(4, 500)
    labels = spark.createDataFrame(rows, LABELS)
    buckets = {r.key: r.bucket for r in sp.iterative_split(labels).collect()}
    test = {k for k, b in buckets.items() if b == "test"}
    assert test == {r.key for r in sp.iterative_folds(labels, 5).where("fold = 1").collect()}
    assert 0.15 < len(test) / len(buckets) < 0.25
