import hashlib

import pytest
from pyspark.sql import functions as F

from chartloom.llm import fingerprints as fp

WORDS = "one two three four five six seven eight nine ten eleven twelve".split()


def _shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_short_sets_give_exact_figures(documents):
    pairs = [(3, " ".join(WORDS)), (7, " ".join(WORDS[:9])), (9, "a b"), (5000, None), (90000, ""), (2, "a\tb  "), (2, "z" * 3)]
    got = fp.fingerprint_report(documents(pairs)).collect()
    assert len(got) == len(pairs)
    order = sorted(((i, t or "") for i, t in pairs), key=lambda p: (p[0], p[1]))
    by_key = {(r.doc_id, r.n_chars): r for r in got}
    for (i, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        r, half = by_key[i, len(text)], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, r.near_edited), (following, r.near_next)):
            a, b = _shingles(text), _shingles(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert by_key[9, 3].fingerprint == by_key[2, 5].fingerprint != by_key[5000, 0].fingerprint


def test_lengths_one_to_six_have_distinct_fingerprints(documents):
    pairs = [(n, " ".join(WORDS[:n])) for n in range(1, 7)]
    got = fp.fingerprint_report(documents(pairs)).collect()
    assert len({r.fingerprint for r in got}) == 6


def test_estimates_of_large_sets_and_merging(spark):
    text = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 4000), (1000, 4000), (0, 2000), (2000 - 4, 4000))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "id long, t string")
    sk = fp.with_sketch(df, F.col("t"), "s")
    a, b = (sk.where(f"id = {i}").select(F.col("s").alias(n)) for i, n in ((0, "a"), (1, "b")))
    row = a.join(b).select(
        fp.resemblance(F.col("a"), F.col("b")).alias("j"),
        fp.containment(F.col("b"), F.col("a")).alias("c"),
        fp.distinct_count(F.col("a")).alias("n"),
    ).first()
    assert row.j == pytest.approx(0.75, abs=0.15) and row.c > 0.75 and row.n == pytest.approx(3996, rel=0.3)
    parts = fp.merge_sketches(sk.where("id >= 2").withColumn("k", F.lit(1)), ["k"], "s").first().s
    assert parts == sk.where("id = 0").first().s


def test_empty_table_and_single_document(documents):
    assert fp.fingerprint_report(documents([])).count() == 0
    only = fp.fingerprint_report(documents([(None, "a b c")])).first()
    assert (only.near_next, only.n_chars) == (1.0, 5)
    assert only.edited_sha256 == hashlib.sha256(b"a ba ").hexdigest()
