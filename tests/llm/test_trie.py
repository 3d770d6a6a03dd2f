import hashlib
import random
import zlib

import numpy as np
import pytest

from chartloom.llm import trie
from chartloom.session import materialize

ROWS = "conv_id long, turn long, role string, text string, depth string, shard string, g long"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    base = {c: c - int(np.fmod(c, 100)) for c in own}
    whole = {c: own.get(base[c], [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(n) == len(node) + 1 for n in below),
                sum(not any(m[: len(n)] == n and len(m) > len(n) for m in below) for n in below),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def odd_rows(seed):
    """Shared beginnings, turnless and absent bases, ties, nulls, repeated rows, negative ids, one long conversation."""
    r = random.Random(seed)
    said = [("user", "a"), ("assistant", "bé"), (None, "a"), ("user", None), ("", ""), ("user", "ab")]
    rows = []
    for c in [0, 1, 2, 3, 4, 7, 12, 55, 99, 105, 131, 199, 200, 201, 250, 299, -100, -101, -5, 2**40 + 7]:
        for turn in range(r.randrange(1, 9)):
            rows.append((c, r.choice([turn, None, 3]), *r.choice(said)))
    rows += [(300, t, "user", "same") for t in range(40)] + [(c, t, "user", "same") for c in (301, 302) for t in range(30)]
    return rows + rows[:5] + [(None, 1, "user", "nobody's")]


def answers(spark, rows, collect, **how):
    table = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], ROWS).repartition(4)
    turns = materialize(trie.numbered_turns(table, stretch=how.pop("stretch", trie.STRETCH)), "turns")
    turns = trie.hundred_prefix(turns)
    return collect(trie.prefix_trie(turns, **how))


@pytest.mark.parametrize("seed", [1, 2])
def test_every_node_equals_brute_force(spark, rows, seed):
    data = odd_rows(seed)
    assert answers(spark, data, rows) == brute(data)


def test_small_shards_bands_and_stretches_change_nothing(spark, rows):
    data = odd_rows(3)
    want = brute(data)
    assert answers(spark, data, rows, stretch=3, shard_rows=5, band=4, many_children=2) == want


def test_paths_of_long_conversations_are_hashed_in_stretches(spark, rows):
    data = [(c, t, "user", f"{t % 3}") for c in (1, 2, 400) for t in range(25)]
    turns = trie.hundred_prefix(trie.numbered_turns(spark.createDataFrame([(*r, "", "", 0) for r in data], ROWS)))
    assert rows(trie.paths(turns, stretch=4)) == rows(trie.paths(turns))


def test_no_conversations_no_nodes(spark, rows):
    assert answers(spark, [], rows) == []
    assert answers(spark, [(None, 1, "user", "x")], rows) == []


def test_a_conversation_left_without_turns_ends_at_the_root(spark, rows):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    assert answers(spark, [(c, 0, "user", "only")], rows) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())
    ]


def test_the_ends_of_a_node_are_digested_block_by_block(spark, rows, monkeypatch):
    monkeypatch.setattr(trie, "_ID_BLOCK", 2)
    ids = [-9, -1, 0, 3, 4, 5, 20, 100]
    table = spark.createDataFrame([(c, 0, 0, 0, 0) for c in ids], "conv_id long, depth long, a long, b long, n_turns long")
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert rows(trie.end_digests(table)) == [(0, 0, 0, want)]


def test_the_queue_gives_rows_in_order_however_often_it_spills():
    r = np.random.default_rng(5)
    for limit in (1, 7, 1000):
        queue, held = trie.SpillingQueue(4, 3, limit), []
        low = 0
        for _ in range(30):
            new = r.integers(0, 6, (r.integers(0, 20), 4))
            new[:, 0] = np.maximum(new[:, 0], low)
            queue.push(new)
            held += map(tuple, new.tolist())
            last = (low, *r.integers(0, 6, 2).tolist())
            out = [tuple(x) for x in queue.pop_through(last).tolist()]
            want = [x for x in held if x[:3] <= last]
            assert sorted(out) == sorted(want) and [x[:3] for x in out] == sorted(x[:3] for x in want)
            held = [x for x in held if x[:3] > last]
            low = min(5, low + int(r.integers(0, 2)))
