import math
import random
import re
from collections import Counter

import numpy as np

from chartloom.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, score string, rank int, item_id long"
ITEMS = "item_id long, text string, doc_id string"


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(i, Counter(split(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, text in set(items):
        asked.setdefault(i, Counter()).update(split(text))
    out = []
    for item, query in asked.items():
        found = []
        for doc, c in counted:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_terms if n_terms else 0
            score = sum(
                q
                * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t, q in query.items()
                if c[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def corpus(seed, n=300):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "été", "a-b", "x_y", "日本", " ", "I'm", "THE", "the"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i * 3, " ".join(r.choices(words, weights, k=r.choice([1, 3, 10, 40, 200])))) for i in range(n)]
    docs += docs[:7] + [(None, docs[3][1]), (None, None), (5, ""), (6, " .,-!"), (9000, docs[0][1]), (8000, docs[0][1])]
    items = [(i, " ".join(r.choices(words, k=r.choice([1, 2, 5, 30])))) for i in range(25)]
    items += [(0, items[0][1]), (1, "w1 w2 absent"), (None, "w3"), (98, None), (99, "--"), (97, "absent")]
    return docs, items


def test_ranks_equal_brute_force_over_many_chunks(spark, rows):
    docs, items = corpus(1)
    table = spark.createDataFrame([(*d, "s", 1, 2) for d in docs], DOCS).repartition(5)
    queries = spark.createDataFrame([(*i, "d") for i in items], ITEMS)
    for k, chunk in ((20, 1000), (3, 100_000_000), (1, 1)):
        assert rows(search.search(table, queries, k, chunk)) == brute(docs, items, k)


def test_blocks_of_queries_change_nothing(spark, rows, monkeypatch):
    docs, items = corpus(2)
    monkeypatch.setattr(search, "BLOCK_ROWS", 9)
    table = spark.createDataFrame([(*d, "s", 1, 2) for d in docs], DOCS)
    queries = spark.createDataFrame([(*i, "d") for i in items], ITEMS)
    assert rows(search.search(table, queries, 5, 5000)) == brute(docs, items, 5)


def test_empty_tables(spark, rows):
    docs, items = corpus(3, 5)
    some = spark.createDataFrame([(*d, "s", 1, 2) for d in docs], DOCS)
    none = spark.createDataFrame([], DOCS)
    asked = spark.createDataFrame([(*i, "d") for i in items], ITEMS)
    assert rows(search.search(none, asked)) == []
    assert rows(search.search(some, spark.createDataFrame([], ITEMS))) == []
    blank = spark.createDataFrame([(1, " ", "s", 1, 2), (2, None, "s", 1, 2)], DOCS)
    assert rows(search.search(blank, asked)) == []


def test_a_very_long_text_is_searched_whole(spark, rows):
    docs = [(1, "filler " * 300_000 + "needle"), (2, "needle thread"), (3, "thread")]
    items = [(1, "needle"), (2, "thread needle needle")]
    table = spark.createDataFrame([(*d, "s", 1, 2) for d in docs], DOCS)
    assert rows(search.search(table, spark.createDataFrame([(*i, "d") for i in items], ITEMS))) == brute(docs, items, 20)


def test_common_terms_open_no_accumulators_once_they_cannot_matter():
    r = np.random.default_rng(4)
    chunk = search.Chunk.__new__(search.Chunk)
    sizes = [25, 40, 900, 950]
    at = [np.sort(r.choice(1000, n, replace=False)) for n in sizes]
    ends = np.cumsum(sizes)
    chunk.size, chunk.at = 1000, np.concatenate(at)
    chunk.cut = {t: slice(e - n, e) for t, (e, n) in enumerate(zip(ends.tolist(), sizes, strict=True))}
    chunk.worth = r.integers(500_000, 900_000, ends[-1])
    chunk.most = {t: int(chunk.worth[c].max()) for t, c in chunk.cut.items()}
    plan = [(0, 9000), (1, 8000), (2, 100), (3, 50)]
    every = np.zeros(1000, np.int64)
    for t, w in plan:
        every[chunk.at[chunk.cut[t]]] += w * chunk.worth[chunk.cut[t]]
    scores = np.zeros(1000, np.int64)
    live, opened = search.accumulate(chunk, plan, scores, 20, 1)
    assert opened == 2 and len(live) <= 65
    assert (scores[live] == every[live]).all()
    best = np.argsort(-every, kind="stable")[:20]
    assert set(best.tolist()) <= set(live.tolist())
    assert search.accumulate(chunk, plan, np.zeros(1000, np.int64), 20, 10**12)[1] == 0
