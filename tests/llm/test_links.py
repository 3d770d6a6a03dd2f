import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from chartloom.llm import components, simhash, suffix, vectors


def _components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_components_of_chains_hubs_and_loops(spark, rows):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (20, 0), (20, 0)]
    got = dict(rows(components.connected(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 140), 100)}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_report_equals_brute_force(documents, rows):
    rng = random.Random(3)
    base = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(400))
    pairs = [(i, base if i % 3 else base.replace("alpha", "ALPHA", i)) for i in range(5, 40)]
    pairs += [(100 + i, " ".join([*base.split()[: 400 - i], "x"])) for i in range(30)]
    pairs += [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (90, "ONE"), (91, "Éa é"), (None, "lone words here")]
    got = simhash.near_duplicates(documents(pairs)).collect()
    prints = {}
    for i, t in pairs:
        prints.setdefault(_fingerprint(t), []).append(i)
    groups = _components(list(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for f, g in groups.items():
        ids = [i for i in prints[f] if i is not None]
        if ids:
            least[g] = min(least.get(g, 10**9), *ids)
    want = sorted(
        ((i, f"{_fingerprint(t):016x}", least.get(groups[_fingerprint(t)])) for i, t in pairs), key=str
    )
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("limit", [2, 10_000])
def test_short_and_long_posting_lists_find_the_same_components(spark, monkeypatch, limit):
    rng = random.Random(5)
    prints = {rng.getrandbits(64)}
    while len(prints) < 120:
        p = rng.choice(sorted(prints))
        for _ in range(rng.randint(1, 3)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    monkeypatch.setattr(simhash, "PAIR_LIST", limit)
    edges = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    found = {r.node: r.component for r in components.connected(edges).collect()}
    want = _components(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    assert {n: found.get(n, n) for n in signed} == want


def test_one_document_of_each_group_stays(documents, rows):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(5, text), (2, text), (9, "something else altogether"), (2, text), (None, text), (None, text)])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert [r[0] for r in rows(kept)] == [2, 9, None, None]


def test_suffix_array_by_grouping():
    rng = random.Random(1)
    for _ in range(500):
        text = [rng.randint(0, rng.randint(0, 3)) for _ in range(rng.randint(0, 40))]
        assert suffix.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def _removed(docs):
    out = []
    for i, b in docs:
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if any(j is not None and (i is None or j < i) and b[s : s + 50] in other for j, other in docs):
                gone[s : s + 50] = b"\1" * 50
        out.append((i, len(b), bytes(x for x, g in zip(b, gone, strict=True) if not g), sum(gone)))
    return sorted(out, key=str)


def test_passages_go_as_brute_force_says(documents):
    rng = random.Random(2)

    def words(n):
        return " ".join("".join(rng.choice("abcdé") for _ in range(5)) for _ in range(n))

    passage, license_ = words(15), words(12)
    pairs = [(i, words(8) + passage + words(6) if i % 2 else words(10) + license_ + passage) for i in range(30, 50)]
    pairs += [(7, passage), (8, passage), (8, passage), (3, None), (4, ""), (60, "a" * 300), (61, "a" * 120), (62, "ab" * 80)]
    pairs += [(63, "x" * 49), (64, "x" * 49), (None, passage + "tail"), (65, passage[:49]), (66, words(400)), (67, "  ")]
    got = suffix.dedup(documents(pairs)).collect()
    found = sorted(((r.doc_id, r.n_bytes, bytes(r.kept), sum(s.end - s.start for s in r.spans)) for r in got), key=str)
    assert found == _removed([(i, (t or "").encode()) for i, t in pairs])
    for r in got:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_thinned_texts_keep_their_rows_and_stay_valid(documents, rows):
    passage = "é" * 40
    docs = documents([(1, passage + "a"), (2, "b" + passage), (3, None), (4, ""), (None, "short")])
    thin = suffix.thin(docs)
    assert thin.columns == docs.columns
    by_id = {r.doc_id: r for r in thin.collect()}
    assert len(by_id) == 5
    assert (by_id[2].text, by_id[2].n_chars) == ("b", 1)
    assert (by_id[1].text, by_id[3].text, by_id[None].text, by_id[1].score) == (passage + "a", None, "short", "x")
    assert suffix.dedup(documents([])).count() == suffix.thin(documents([])).count() == 0


def test_buckets_of_anchors_hold_equal_shares():
    """An anchor is the least gram of a window, so anchors' hashes are low; even ranges put a fifth of them into the first of 64."""
    text = np.random.default_rng(6).integers(97, 123, 400_000).astype(np.uint8)
    hashes = np.sort(suffix.anchors(text, np.array([200_000, 400_000]))[0])
    for buckets in (1, 64):
        edges = suffix._anchor_edges(buckets)
        cuts = suffix._by_bucket(hashes, edges)
        sizes = [cut.stop - cut.start for _, cut in cuts]
        assert edges[0] == 0 and (np.diff(edges.astype(np.int64)) >= 0).all()
        assert [b for b, _ in cuts] == list(range(buckets)) and sum(sizes) == len(hashes)
        assert max(sizes) < 1.3 * len(hashes) / buckets
    even = suffix._by_bucket(hashes, suffix._even_edges(64))
    assert max(cut.stop - cut.start for _, cut in even) > 0.15 * len(hashes)


def test_vector_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 60)
    monkeypatch.setattr(vectors, "MAX_SHARD", 120)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    table = []
    for i in range(500):
        v = centres[i % 12] + rng.normal(size=16) * 0.08 if i % 4 == 0 else rng.normal(size=16)
        table.append((1000 + i, [float(x) for x in np.float32(v)], i % 2))
    table += [(1, table[0][1], 0), (2, table[0][1], 0), (3, table[0][1], 1), (4, None, 0), (5, [0.0] * 16, 0)]
    table += [(6, [float("nan")] * 16, 0), (7, [None] * 16, 0), (8, table[0][1], None), (9, [2 * x for x in table[0][1]], 0), (10, [], 1)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v, float) / np.linalg.norm(np.array(v, float))

    known = {i: (unit(v), lab) for i, v, lab in table}

    def linked(a, b):
        (u, x), (v, y) = known[a], known[b]
        return u is not None and v is not None and x is not None and x == y and u @ v >= 0.98

    want = _components(list(known), linked)
    n = {a: sum(linked(a, b) for b in known if b != a) for a in known}
    assert len(got) == len(known)
    assert all(got[i].n_links <= n[i] for i in known)
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(n.values())
    assert np.mean([got[i].component_id == want[i] for i in known]) >= 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert vectors.near_duplicates(df.where("vec_id < 0")).count() == 0


def _jittered(rng, groups, copies, jitter, size=16):
    centres = rng.normal(size=(groups, size))
    x = np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True), copies, axis=0)
    x += rng.normal(size=x.shape) * jitter
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_groups_larger_than_the_pool_are_searched_whole():
    x = _jittered(np.random.default_rng(8), 10, 100, 0.02)
    graph = vectors.tie_islands(x, vectors.robust_prune(x))
    want = [set(np.flatnonzero(row >= vectors.COSINE)) - {i} for i, row in enumerate(x @ x.T)]
    found = dict(vectors.range_search(x, graph, np.arange(len(x))))
    assert [set(found[i]) for i in range(len(x))] == want


@pytest.mark.parametrize("limit", [40, 0])
def test_knots_are_compared_in_bounded_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(vectors, "MAX_SHARD", 40)
    x = _jittered(np.random.default_rng(9), 2, 150, 0.03)
    table = [(i, x[i].tolist(), 1 + i % 3, s) for i in range(len(x)) for s in ("a", "b!")[: 1 + (i % 5 > 0)]]
    table += [(i, x[i].tolist(), 1 + i % 3, "0") for i in range(0, len(x), 10)]
    placed = spark.createDataFrame(table, "rep long, v array<double>, n long, shard string").select("rep", "n", "v", "shard")
    sizes = []
    apply = type(placed.groupBy("shard")).applyInPandas

    def sized(self, f, schema):
        sizes.append(self.count())
        return apply(self, f, schema)

    monkeypatch.setattr(type(placed.groupBy("shard")), "applyInPandas", sized)
    got = vectors.links(placed, limit=limit).groupBy("rep").sum("n_links").collect()
    near = x @ x.T >= vectors.COSINE
    np.fill_diagonal(near, False)
    n = 1 + np.arange(len(x)) % 3
    assert {r[0]: r[1] for r in got} == {i: k for i, k in enumerate((near @ n).tolist()) if k}
    assert max(r["count"] for s in sizes for r in s.collect()) < 3 * 40


def test_a_split_whose_vectors_have_no_second_centre_near(spark, monkeypatch):
    """Far groups of a label: no vector goes to a second part, so a task has nothing to send there."""
    monkeypatch.setattr(vectors, "SHARD", 40)
    monkeypatch.setattr(vectors, "MAX_SHARD", 80)
    rng = np.random.default_rng(4)
    x = np.repeat(np.eye(8)[:2], 100, axis=0) + 0.02 * rng.standard_normal((200, 8))
    unit = x.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    placed = vectors.shards(vectors.distinct_vectors(df)).collect()
    assert sorted(r.rep for r in placed) == list(range(200))
    together = {}
    for r in placed:
        together.setdefault(r.shard, set()).add(r.rep // 100)
    assert all(len(groups) == 1 for groups in together.values())
    assert [r.n_links for r in vectors.near_duplicates(df).orderBy("vec_id").collect()] == [
        int(n) - 1 for n in (unit @ unit.T >= vectors.COSINE).sum(axis=1)
    ]


def test_vectors_of_a_chain_are_one_component(spark):
    angle = {1: 0.0, 3: 0.15, 2: 0.3, 4: 0.45}  # in order of angle: only neighbours link
    table = [(i, [float(np.cos(a)), float(np.sin(a))], 0) for i, a in angle.items()]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect()}
    assert got == {1: (1, 1), 3: (2, 1), 2: (2, 1), 4: (1, 1)}


def test_no_group_grows_with_an_anchor_of_many_stretches(documents, monkeypatch):
    rng = random.Random(6)
    phrase, copied = "all rights reserved by the house xyzw ", "\0" * 10 + "".join(rng.choice("abcdefgh") for _ in range(70))

    def noise(n):
        return "".join(rng.choice("ijklmnopqrstuvé") for _ in range(n))

    pairs = [(i, noise(26) + phrase + noise(26)) for i in range(10_000, 16_000)]
    repeated = [pairs[i][1] for i in (5, 5, 700, 5999)]
    pairs += [(20_000 + i, noise(9) + t[10:80] + noise(9)) for i, t in enumerate(repeated)]
    pairs += [(i, noise(3) + copied + phrase + noise(40)) for i in range(20_010, 20_020)]
    pairs += [(None, repeated[0]), (9, None), (8, phrase)]
    docs = documents(pairs)
    sort = suffix._sort_stretches

    def counted(table):
        out = sort(table)
        for kind, n in zip(table.column("kind").to_pylist(), table.column("n").to_pylist(), strict=True):
            if kind == 0 and n > 1500:
                raise ValueError(f"{n} stretches of one chunk in a bucket")
        return out

    monkeypatch.setattr(suffix, "_sort_stretches", counted)
    got = suffix.dedup(docs).collect()
    found = sorted(((r.doc_id, r.n_bytes, bytes(r.kept), sum(s.end - s.start for s in r.spans)) for r in got), key=str)
    first = {}  # window -> least document that has it
    texts = [(i, (t or "").encode()) for i, t in pairs]
    for i, b in texts:
        for s in range(len(b) - 49):
            w, k = b[s : s + 50], float("inf") if i is None else i
            first[w] = min(first.get(w, k), k)
    want = []
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < (float("inf") if i is None else i):
                gone[s : s + 50] = b"\1" * 50
        want.append((i, len(b), bytes(x for x, g in zip(b, gone, strict=True) if not g), sum(gone)))
    assert found == sorted(want, key=str)
