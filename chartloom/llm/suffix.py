"""Removal of passages that repeat across documents, by suffix sorting.

Windows of 50 bytes that are equal share the same least 25-byte gram (their anchor), so
windows meet by anchor: anchors are counted over all documents, and the stretches of text
around anchors that more than one document has are brought together. Per anchor the
suffixes of those stretches are sorted by linear grouping construction; equal windows are
then neighbours, and each learns the least doc_id that has it. Round a crowded anchor, one with
very many different stretches, windows meet by a hash of all their bytes instead.
Documents are read in chunks; a chunk sends each stretch once, so a passage that fills the
corpus costs one row a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.blocks import packed, unpacked
from chartloom.llm.tokens import gather
from chartloom.session import materialize, ship_package

WINDOW = 50
GRAM = 25
CHUNK_BYTES = 4 << 20
# An anchor's order: 46 bits of its hash, then its place in a segment of the text.
_PLACE = 18
_SEGMENT = 1 << _PLACE
# An anchor is crowded if the hash of one of its stretches begins with so many zero bits: it
# then has about 2 ** CROWDED different ones, and hardly ever 20 times that unnoticed.
CROWDED = 10
_NO_ID = np.iinfo(np.int64).max
# The longest stretch: windows of one anchor begin at most WINDOW - GRAM bytes apart.
_WIDTH = 2 * WINDOW - GRAM


# --- linear grouping construction ---------------------------------------------------


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of a text by linear grouping.

    First suffixes are grouped by their Lyndon prefix. Groups are taken in descending
    order; each suffix of a group points to its previous smaller suffix, whose prefix it
    prolongs, and the parents of a group are split off above those they were with, the more
    prolonged the higher. Then each group's order is emitted: going up the array, a suffix
    places all suffixes whose Lyndon prefix ends where it begins.
    """
    n = len(text)
    if not n:
        return []
    end = list(range(1, n + 1))  # where the Lyndon prefix known so far ends
    before = [-1] * n
    done = [False] * n
    letters = sorted(set(text))
    number = {c: g for g, c in enumerate(letters)}
    group = [number[c] for c in text]
    members: list[set[int]] = [set() for _ in letters]
    for i, g in enumerate(group):
        members[g].add(i)
    below = list(range(-1, len(letters) - 1))
    above = [*range(1, len(letters)), -1]
    g = len(letters) - 1
    while g >= 0:
        if len(members[g]) == 1:  # the usual case once groups are small: one suffix, one parent
            (s,) = members[g]
            p = s - 1
            while p >= 0 and done[p]:
                p = before[p]
            before[s] = p
            done[s] = True
            if p >= 0:
                if end[p] < end[s]:
                    end[p] = end[s]
                old = group[p]
                if len(members[old]) > 1:
                    members[old].discard(p)
                    group[p] = len(members)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = group[p]
                    if up >= 0:
                        below[up] = group[p]
                    members.append({p})
            g = below[g]
            continue
        children: dict[int, int] = {}
        for s in sorted(members[g]):
            p = s - 1
            while p >= 0 and (done[p] or group[p] == g):
                p = before[p]
            before[s] = p
            if p >= 0:
                children[p] = children.get(p, 0) + 1
                if end[p] < end[s]:
                    end[p] = end[s]
        for s in members[g]:
            done[s] = True
        parted: dict[int, dict[int, list[int]]] = {}
        for p, k in children.items():
            parted.setdefault(group[p], {}).setdefault(k, []).append(p)
        for old, by_count in parted.items():
            rest = members[old]
            at = old
            for k in sorted(by_count):
                moved = by_count[k]
                if len(moved) == len(rest):  # the whole of what is left moves: it stays one group
                    break
                rest.difference_update(moved)
                new = len(members)
                members.append(set(moved))
                for p in moved:
                    group[p] = new
                up = above[at]
                below.append(at)
                above.append(up)
                above[at] = new
                if up >= 0:
                    below[up] = new
                at = new
            else:
                continue
            # The last count's members were all that was left of the old group: it goes on
            # top of the groups split from it.
            if at != old:
                lower, up = below[old], above[old]
                below[up] = lower
                if lower >= 0:
                    above[lower] = up
                top = above[at]
                above[at], below[old], above[old] = old, at, top
                if top >= 0:
                    below[top] = old
        g = below[g]
    ends_at: list[list[int]] = [[] for _ in range(n + 1)]
    for i, e in enumerate(end):
        ends_at[e].append(i)
    lowest = 0
    while below[lowest] >= 0:
        lowest = below[lowest]
    free = [0] * len(members)
    start, g = 0, lowest
    while g >= 0:
        free[g] = start
        start += len(members[g])
        g = above[g]
    out = [-1] * n
    for i in ends_at[n]:
        out[free[group[i]]] = i
        free[group[i]] += 1
    for k in range(n):
        for i in ends_at[out[k]]:
            out[free[group[i]]] = i
            free[group[i]] += 1
    return out


def _agreement(texts: list[bytes]) -> list[int]:
    """Per text the longest prefix that it shares with any other one."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    out = [0] * len(texts)
    for a, b in zip(order, order[1:], strict=False):
        n = min(len(texts[a]), len(texts[b]))
        differ = int.from_bytes(texts[a][:n]) ^ int.from_bytes(texts[b][:n])
        shared = n - (differ.bit_length() + 7) // 8
        out[a], out[b] = max(out[a], shared), max(out[b], shared)
    return out


def least_owner(stretches: list[bytes], owners: list[int], places: list[int], window: int = WINDOW) -> list[list[int]]:
    """Per stretch and window in it the least owner of a stretch that has the window.

    ``places`` say where in a stretch the anchor is that all of them share. Equal windows
    have it at equal places, so a window reaches no farther from it, either way, than the
    stretch agrees with some other one; only what lies inside that is sorted.
    """
    out = [[m] * (len(s) - window + 1) for s, m in zip(stretches, owners, strict=True)]
    if len(stretches) == 1:
        return out
    left = _agreement([s[:p][::-1] for s, p in zip(stretches, places, strict=True)])
    right = _agreement([s[p:] for s, p in zip(stretches, places, strict=True)])
    text: list[int] = []
    own: list[int] = []
    starts = []
    parts = []
    for k, (s, p, lo, hi) in enumerate(zip(stretches, places, left, right, strict=True)):
        starts.append(len(text) - (p - lo))
        if lo + hi >= window:
            part = s[p - lo : p + hi]
            text += [b + 1 for b in part]
            text.append(0)  # below every byte, so no window runs on into the next stretch
            own += [k] * (len(part) - window + 1) + [-1] * window
            parts.append(part)
    if len(parts) < 2:
        return out
    joined = b"\0".join(parts)
    last, same = b"", []

    def settle() -> None:
        if same:
            least = min(owners[own[i]] for i in same)
            for i in same:
                out[own[i]][i - starts[own[i]]] = least
            same.clear()

    for i in suffix_array(text):
        if own[i] >= 0:
            piece = joined[i : i + window]
            if piece != last:
                settle()
                last = piece
            same.append(i)
    settle()
    return out


# --- anchors -------------------------------------------------------------------------

_TABLE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def _gram_hashes(b: np.ndarray, k: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every k-gram."""
    n = len(b) - k + 1
    current, power, length, parts = _TABLE[b], 0x9E3779B97F4A7C15, 1, []
    while True:
        if k & length:
            parts.append((length, current, power))
        if 2 * length > k:
            break
        current = current[:-length] * np.uint64(power) + current[length:]
        power, length = power * power % 2**64, 2 * length
    out, at = None, 0
    for length, hashes, power in reversed(parts):
        part = hashes[at : at + n]
        out = part if out is None else out * np.uint64(power) + part
        at += length
    return _mixed(out)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        v, length = np.minimum(v[:-length], v[length:]), 2 * length
    rest = width - length
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def anchors(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last, place) of runs of windows with one anchor.

    A run's first window begins at first, its last one at last, and the anchor at place.

    ``text`` holds documents end to end; no window runs over an end. An anchor is a
    window's least gram by hash, the first of equal ones, so equal windows have equal
    anchors at equal places.
    """
    return _ranked_anchors(text, ends)[:4]


def _ranked_anchors(
    text: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``anchors``, and of each run how many zero bits a hash of its stretch begins with."""
    found = []
    step = _SEGMENT - WINDOW
    document = np.searchsorted(ends, np.arange(0, len(text), step), side="right")
    for lo, doc in zip(range(0, len(text) - WINDOW + 1, step), document, strict=False):
        b = text[lo : lo + _SEGMENT]
        if len(b) < WINDOW:
            continue
        grams = _gram_hashes(b)
        grams &= ~np.uint64(_SEGMENT - 1)
        grams |= np.arange(len(grams), dtype=np.uint64)
        least = _sliding_min(grams, WINDOW - GRAM + 1)[:step]
        whole = np.ones(len(least), bool)
        for e in ends[doc:]:
            if e - WINDOW + 1 - lo >= len(least):
                break
            whole[max(0, e - WINDOW + 1 - lo) : max(0, e - lo)] = False
        starts = np.ones(len(least), bool)
        starts[1:] = (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])
        change = np.flatnonzero(starts)
        last = np.append(change[1:], len(least)) - 1
        use = whole[change]
        change, last = change[use], last[use]
        place = (least[change] & np.uint64(_SEGMENT - 1)).astype(np.int64)
        # The first and the last gram with the anchor between them cover the stretch.
        edge = grams >> np.uint64(_PLACE)
        whole = _mixed(edge[change] * np.uint64(0x9E3779B97F4A7C15) + edge[last + WINDOW - GRAM])
        rank = (64 - np.frexp(whole.astype(np.float64))[1]).astype(np.uint8)
        found.append((least[change] >> np.uint64(_PLACE), change + lo, last + lo, place + lo, rank))
    if not found:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint8)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


# --- chunks of documents ---------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, list[bytes], pa.Table]]:
    """(chunk, ids, texts, whatever columns follow those two)."""
    part, chunk, size = TaskContext.get().partitionId(), 0, 0
    held: list[pa.RecordBatch] = []

    def whole() -> tuple[int, np.ndarray, list[bytes], pa.Table]:
        table = pa.Table.from_batches(held)
        ids = pc.fill_null(table.column(0), _NO_ID).to_numpy()
        texts = [t.encode("utf-8", "surrogatepass") for t in pc.fill_null(table.column(1), "").to_pylist()]
        return part << 24 | chunk, ids, texts, table.select(table.schema.names[2:])

    for batch in batches:
        # A chunk ends by its texts alone, whatever other columns are read and however rows are batched.
        start = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
            size += n + 64
            if size >= CHUNK_BYTES:
                held.append(batch.slice(start, i + 1 - start))
                yield whole()
                chunk, size, start, held = chunk + 1, 0, i + 1, []
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield whole()


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts], dtype=np.int64)


def _even_edges(buckets: int) -> np.ndarray:
    """Where buckets begin that hold equal shares of the hash space."""
    return np.array([(b << 46) // buckets for b in range(buckets)], np.uint64)


def _anchor_edges(buckets: int) -> np.ndarray:
    """Where buckets begin that hold equal shares of the anchors' hashes.

    A gram of hash h (of 0 to 1) is an anchor if at least m = WINDOW - GRAM grams in a row on both sides together have
    higher ones: with a chance of (1 - h)**m * (1 + m * h). So anchors' hashes are low, and even ranges would
    give the first bucket about m / 2 times its share. To be worked out once: tasks have to agree on every bit.
    """
    m = WINDOW - GRAM
    u = np.linspace(1, 0, 1 << 16)  # 1 - h, as chances need not be exact
    share = 1 - u ** (m + 1) * (m + 2 - m * u) / 2
    low = 1 - np.interp(np.arange(buckets) / buckets, share, u)
    return np.maximum.accumulate((low * (1 << 46)).astype(np.uint64))


def _by_bucket(hashes: np.ndarray, edges: np.ndarray) -> list[tuple[int, slice]]:
    """Cuts of sorted hashes into ranges, one per bucket."""
    cuts = [*np.searchsorted(hashes, edges).tolist(), len(hashes)]
    return [(b, slice(lo, hi)) for b, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)) if hi > lo]


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk, ids, texts, rest in _chunks(batches):
        data, ends = _joined(texts)
        sizes = np.diff(ends, prepend=0)
        carried = pa.BufferOutputStream()
        with pa.ipc.new_stream(carried, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rest)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk]),
                pa.array([len(ids)]),
                pa.array([len(data)]),
                pa.array([packed(ids, sizes, data)], pa.binary()),
                pa.array([carried.getvalue().to_pybytes()], pa.binary()),
            ],
            ["chunk", "n", "n_bytes", "block", "carried"],
        )


def _unpack_texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row = table.to_pylist()[0]
    ids, sizes, data = unpacked(row["block"], ("<i8", row["n"]), ("<i8", row["n"]), ("u1", row["n_bytes"]))
    return ids, np.cumsum(sizes), data


def _steps(sorted_hashes: np.ndarray) -> np.ndarray:
    return np.diff(sorted_hashes, prepend=np.uint64(0)).astype(np.uint64)


def _send_hashes(edges: np.ndarray):
    """Distinct anchor hashes of a chunk per bucket; those of two of its documents are marked.

    With each goes the highest rank of its stretches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, texts, _ in _chunks(batches):
            data, ends = _joined(texts)
            hashes, first, _, _, rank = _ranked_anchors(data, ends)
            owner = ids[np.searchsorted(ends, first, side="right")]
            order = np.argsort(hashes, kind="stable")
            hashes, owner, rank = hashes[order], owner[order], rank[order]
            start = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else order
            if not len(start):
                continue
            several = np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)
            hashes, rank = hashes[start], np.maximum.reduceat(rank, start)
            # Only whether it is crowded matters; equal bytes pack well.
            marks = several.astype(np.uint8) | (rank >= CROWDED).astype(np.uint8) << 1
            rows = [
                (b, chunk, cut.stop - cut.start, packed(_steps(hashes[cut]), marks[cut]))
                for b, cut in _by_bucket(hashes, edges)
            ]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["bucket", "chunk", "n", "block"],
            )

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Of one bucket: per chunk the hashes that more than one document has, those crowded marked."""
    chunks, hashes, marks = [], [], []
    for chunk, n, block in zip(*(table.column(c).to_pylist() for c in ("chunk", "n", "block")), strict=True):
        step, mark = unpacked(block, ("<u8", n), ("u1", n))
        chunks.append(chunk)
        hashes.append(np.cumsum(step, dtype=np.uint64))
        marks.append(mark)
    every = np.sort(np.concatenate(hashes))
    twice = every[1:][every[1:] == every[:-1]]
    inside = np.concatenate([h[m & 1 > 0] for h, m in zip(hashes, marks, strict=True)])
    crowded = np.unique(np.concatenate([h[m & 2 > 0] for h, m in zip(hashes, marks, strict=True)]))
    common = np.unique(np.concatenate([twice, inside]))
    rows = []
    for chunk, own in zip(chunks, hashes, strict=True):
        own = own[np.isin(own, common, assume_unique=True)]
        if len(own):
            rows.append((chunk, len(own), packed(_steps(own), np.isin(own, crowded).astype(np.uint8))))
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.table(
        {
            "chunk": pa.array(columns[0], pa.int64()),
            "n": pa.array(columns[1], pa.int64()),
            "block": pa.array(columns[2], pa.binary()),
        }
    )


def _cut(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of ``data`` as rows of bytes, zeros behind the shorter ones and the size at the end."""
    out = np.zeros((len(first), _WIDTH + 1), np.uint8)
    at = np.arange(_WIDTH)
    for lo in range(0, len(first), 100_000):
        part = slice(lo, lo + 100_000)
        own = first[part, None] + at
        inside = at < size[part, None]
        np.minimum(own, len(data) - 1, out=own)
        out[part, :_WIDTH] = data[own] * inside
    out[:, _WIDTH] = size
    return out


def _filled(text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows as those of ``_cut`` from stretches that stand end to end in ``text``."""
    out = np.zeros((len(size), _WIDTH + 1), np.uint8)
    out[:, :_WIDTH][np.arange(_WIDTH) < size[:, None]] = text
    out[:, _WIDTH] = size
    return out


def _end_to_end(rows: np.ndarray) -> np.ndarray:
    return rows[:, :_WIDTH][np.arange(_WIDTH) < rows[:, _WIDTH :]]


def _told_apart(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the stretch in each row, row where each stretch first stands)."""
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = pa.binary(_WIDTH + 1)
    same = pa.FixedSizeBinaryArray.from_buffers(kind, len(rows), [None, pa.py_buffer(rows)]).dictionary_encode()
    number = same.indices.to_numpy().astype(np.int64)
    first = np.empty(len(same.dictionary), np.int64)
    first[number[::-1]] = np.arange(len(rows))[::-1]
    return number, first


class _Stretches(NamedTuple):
    """Distinct stretches in order of anchor hash, then place in the chunk, and the runs of windows that are each of them."""

    hashes: np.ndarray
    place: np.ndarray  # of the anchor in the stretch
    rows: np.ndarray  # as of ``_cut``
    begins: np.ndarray  # where a stretch's runs begin in the two below
    owner: np.ndarray
    first: np.ndarray


def _stretches(data: np.ndarray, ends: np.ndarray, ids: np.ndarray, common: np.ndarray) -> _Stretches:
    """Stretches of a chunk whose anchor is in ``common``; equal ones have equal anchors at equal places."""
    hashes, first, last, place = anchors(data, ends)
    use = np.isin(hashes, common)
    hashes, first, last, place = hashes[use], first[use], last[use], place[use]
    rows = _cut(data, first, last - first + WINDOW)
    number, seen = _told_apart(rows)
    listed = np.lexsort((seen, hashes[seen]))
    rank = np.empty(len(seen), np.int64)
    rank[listed] = np.arange(len(seen))
    rank = rank[number]
    order = np.argsort(rank, kind="stable")
    at = seen[listed]
    return _Stretches(
        hashes[at],
        (place - first)[at],
        rows[at],
        np.searchsorted(rank[order], np.arange(len(seen))),
        ids[np.searchsorted(ends, first[order], side="right")],
        first[order],
    )


def _windows(
    data: np.ndarray, ends: np.ndarray, ids: np.ndarray, crowded: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a chunk whose anchor is in ``crowded``, in order of a hash of their bytes.

    (hash, first, owner) of each, and where a text begins that the one before does not
    have. Equal windows are neighbours, unless another one has their hash: then a text may
    begin twice.
    """
    hashes, first, last, _ = anchors(data, ends)
    use = np.isin(hashes, crowded)
    first, n = first[use], (last - first)[use] + 1
    first = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    key = np.zeros(len(first), np.uint64)
    for i in range(WINDOW):
        key *= np.uint64(0x9E3779B97F4A7C15)
        key += _TABLE[data[first + i]]
    key = _mixed(key)
    order = np.argsort(key, kind="stable")
    key, first = key[order], first[order]
    begins = np.ones(len(first), bool)
    begins[1:] = key[1:] != key[:-1]
    again = np.flatnonzero(~begins)
    for lo in range(0, len(again), 100_000):
        at = again[lo : lo + 100_000]
        begins[at] = (_texts_at(data, first[at]) != _texts_at(data, first[at - 1])).any(1)
    owner = ids[np.searchsorted(ends, first, side="right")]
    return key, first, owner, np.flatnonzero(begins)


def _texts_at(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    return data[first[:, None] + np.arange(WINDOW)]


def _all_hashes(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, those of them that are crowded)."""
    blocks = zip(*(table.column(c).to_pylist() for c in ("n", "block")), strict=True)
    own = [unpacked(block, ("<u8", n), ("u1", n)) for n, block in blocks]
    if not own:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    hashes = np.concatenate([np.cumsum(step, dtype=np.uint64) for step, _ in own])
    mark = np.concatenate([mark for _, mark in own]) > 0
    return hashes[~mark], np.sort(hashes[mark])


# What a block is about: stretches, windows of crowded anchors, or the chunk's crowded anchors themselves.
_STRETCHES, _WINDOWS, _CROWDED = range(3)
_SENT = "kind int, bucket int, chunk long, n long, n_bytes long, block binary"
_ANSWERED = "kind int, bucket int, chunk long, n long, n_runs long, block binary"
_BLOCK_KINDS = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())


def _block_table(rows: list[tuple], size: str) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 6
    names = ("kind", "bucket", "chunk", "n", size, "block")
    return pa.table({name: pa.array(c, k) for name, c, k in zip(names, columns, _BLOCK_KINDS, strict=True)})


def _send_stretches(edges: np.ndarray):
    buckets = len(edges)

    def run(key: tuple, texts: pa.Table, repeated: pa.Table) -> pa.Table:
        (common, crowded), rows, chunk = _all_hashes(repeated), [], key[0].as_py()
        if texts.num_rows and len(common):
            ids, ends, data = _unpack_texts(texts)
            own = _stretches(data, ends, ids, common)
            least = np.minimum.reduceat(own.owner, own.begins) if len(own.begins) else own.owner
            for b, cut in _by_bucket(own.hashes, edges):
                text, sizes = _end_to_end(own.rows[cut]), own.rows[cut, _WIDTH].copy()
                block = packed(_steps(own.hashes[cut]), least[cut], own.place[cut].astype(np.uint8), sizes, text)
                rows.append((_STRETCHES, b, chunk, len(sizes), len(text), block))
        if texts.num_rows and len(crowded):
            ids, ends, data = _unpack_texts(texts)
            hashes, first, owner, begins = _windows(data, ends, ids, crowded)
            least, first = np.minimum.reduceat(owner, begins), first[begins]
            for b, cut in _by_bucket(hashes[begins] >> np.uint64(_PLACE), _even_edges(buckets)):
                text = _texts_at(data, first[cut]).ravel()
                rows.append((_WINDOWS, b, chunk, len(first[cut]), len(text), packed(least[cut], text)))
            rows.append((_CROWDED, chunk % buckets, chunk, len(crowded), 0, packed(_steps(crowded))))
        return _block_table(rows, "n_bytes")

    return run


def _least_of_windows(blocks: list[tuple[int, int, int, np.ndarray, np.ndarray]]) -> list[tuple]:
    """Answers to one bucket's blocks of windows: the least owner of each."""
    if not blocks:
        return []
    text = pa.py_buffer(np.concatenate([data for *_, data in blocks]))
    owner = np.concatenate([least for *_, least, _ in blocks])
    same = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WINDOW), len(owner), [None, text]).dictionary_encode()
    number = same.indices.to_numpy()
    least = np.full(len(same.dictionary), _NO_ID)
    np.minimum.at(least, number, owner)
    rows, at = [], 0
    for bucket, chunk, n, *_ in blocks:
        rows.append((_WINDOWS, bucket, chunk, n, 0, packed(least[number[at : at + n]])))
        at += n
    return rows


def _sort_stretches(table: pa.Table) -> pa.Table:
    """Of one bucket: per chunk and stretch the runs of windows and their least owners.

    Blocks of crowded anchors' windows get their least owners; what else there is goes on as it is.
    """
    blocks, windows, rows = [], [], []
    for kind, bucket, chunk, n, n_bytes, block in zip(
        *(table.column(c).to_pylist() for c in ("kind", "bucket", "chunk", "n", "n_bytes", "block")), strict=True
    ):
        if kind == _WINDOWS:
            windows.append((bucket, chunk, n, *unpacked(block, ("<i8", n), ("u1", n_bytes))))
        elif kind == _CROWDED:
            rows.append((kind, bucket, chunk, n, 0, block))
        else:
            step, least, place, sizes, text = unpacked(
                block, ("<u8", n), ("<i8", n), ("u1", n), ("u1", n), ("u1", n_bytes)
            )
            blocks.append((bucket, chunk, step, least, place, _filled(text, sizes)))
    rows += _least_of_windows(windows)
    if blocks:
        number, owners = _owners(*(np.concatenate(c) for c in zip(*((_summed(b[2]), *b[3:]) for b in blocks), strict=True)))
        flat_owner, flat_size, counts = owners
        at = 0
        for bucket, chunk, step, least, *_ in blocks:
            own = number[at : at + len(least)]
            at += len(least)
            owner, _ = gather(flat_owner, counts, own)
            size, _ = gather(flat_size, counts, own)
            block = packed(step, counts[own].astype(np.uint8), owner, size)
            rows.append((_STRETCHES, bucket, chunk, len(own), len(owner), block))
    return _block_table(rows, "n_runs")


def _summed(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _owners(
    hashes: np.ndarray, least: np.ndarray, place: np.ndarray, texts: np.ndarray
) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Number of the stretch of each row; runs of equal least owners, (owner, windows), and how many each stretch has.

    Only stretches whose anchor has another one are sorted, anchor by anchor.
    """
    number, seen = _told_apart(texts)
    owner = np.full(len(seen), _NO_ID)
    np.minimum.at(owner, number, least)
    own_hash, size = hashes[seen], texts[seen, _WIDTH].astype(np.int64)
    order = np.argsort(own_hash, kind="stable")
    begins = np.flatnonzero(np.concatenate(([True], np.diff(own_hash[order]) != 0)))
    ends = np.append(begins[1:], len(order))
    flat_owner: list[np.ndarray] = [owner]
    flat_size: list[np.ndarray] = [size - WINDOW + 1]
    counts, start = np.ones(len(seen), np.int64), np.arange(len(seen))
    total = len(seen)
    for lo, hi in zip(begins[ends - begins > 1].tolist(), ends[ends - begins > 1].tolist(), strict=True):
        group = order[lo:hi]
        stretches = [texts[r, :n].tobytes() for r, n in zip(seen[group].tolist(), size[group].tolist(), strict=True)]
        found = least_owner(stretches, owner[group].tolist(), place[seen[group]].tolist())
        for s, owners in zip(group.tolist(), found, strict=True):
            runs = [(m, len(list(same))) for m, same in groupby(owners)]
            flat_owner.append(np.array([m for m, _ in runs], np.int64))
            flat_size.append(np.array([n for _, n in runs], np.int64))
            counts[s], start[s] = len(runs), total
            total += len(runs)
    # Runs in order of their stretch.
    at = np.repeat(start - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    sizes = np.concatenate(flat_size)[at].astype(np.uint8)
    return number, (np.concatenate(flat_owner)[at], sizes, counts)


def _kept_schema(carried: pa.Schema) -> pa.Schema:
    fields = [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
    return pa.schema([*fields, *carried])


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` with every character that loses a byte gone as a whole."""
    character = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
    hit = np.zeros(int(character[-1]) + 1 if len(character) else 1, bool)
    hit[character[gone]] = True
    return hit[character]


def _remove(whole: bool):
    """Kept bytes of a chunk's documents and the spans that went; ``whole``: no character is cut."""

    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        carried = pa.ipc.open_stream(texts.column("carried")[0].as_buffer()).read_all()
        return _removed(key, texts, answers, carried, whole)

    return run


def _marked(own: _Stretches, n_runs: np.ndarray, answers: tuple, length: int) -> np.ndarray:
    """Steps up and down where windows of an earlier owner begin and end: answers of a stretch, for each of its runs."""
    counts, owner, size, before = answers
    out = np.zeros(length, np.int32)
    stretch = np.repeat(np.arange(len(counts)), n_runs)
    for lo in range(0, len(stretch), 200_000):
        which = stretch[lo : lo + 200_000]
        entry, _ = gather(np.arange(len(owner)), counts, which)
        run = np.repeat(np.arange(lo, lo + len(which)), counts[which])
        hit = owner[entry] < own.owner[run]
        entry, place = entry[hit], own.first[run[hit]] + before[entry[hit]]
        np.add.at(out, place, 1)
        np.subtract.at(out, place + size[entry] - 1 + WINDOW, 1)
    return out


def _removed(key: tuple, texts: pa.Table, answers: pa.Table, carried: pa.Table, whole: bool) -> pa.Table:
    ids, ends, data = _unpack_texts(texts)
    marks = np.zeros(len(data) + 1, np.int32)
    parts, windows, crowded = [], {}, None
    for kind, bucket, n, n_runs, block in zip(
        *(answers.column(c).to_pylist() for c in ("kind", "bucket", "n", "n_runs", "block")), strict=True
    ):
        if kind == _WINDOWS:
            windows[bucket] = unpacked(block, ("<i8", n))[0]
            continue
        if kind == _CROWDED:
            crowded = np.cumsum(unpacked(block, ("<u8", n))[0], dtype=np.uint64)
            continue
        parts.append(unpacked(block, ("<u8", n), ("u1", n), ("<i8", n_runs), ("u1", n_runs)))
    if parts:
        # Blocks hold the chunk's stretches in order, bucket by bucket.
        hashes = [_summed(p[0]) for p in parts]
        parts = [parts[i] for i in sorted(range(len(parts)), key=lambda i: int(hashes[i][0]))]
        hashes = np.sort(np.concatenate(hashes))
        _, counts, owner, size = (np.concatenate(c) for c in zip(*parts, strict=True))
        own = _stretches(data, ends, ids, np.unique(hashes))
        if not np.array_equal(own.hashes, hashes):
            raise RuntimeError(f"chunk {key[0]}: its documents changed between two readings")
        counts, size = counts.astype(np.int64), size.astype(np.int64)
        before = np.cumsum(size) - size  # windows before a run of answers, then those in its stretch only
        before -= np.repeat(before[np.cumsum(counts) - counts], counts)
        n_runs = np.diff(own.begins, append=len(own.first))
        marks += _marked(own, n_runs, (counts, owner, size, before), len(marks))
    if crowded is not None:
        _, first, owner, begins = _windows(data, ends, ids, crowded)
        least = np.concatenate([windows[b] for b in sorted(windows)])
        if len(least) != len(begins):
            raise RuntimeError(f"chunk {key[0]}: its documents changed between two readings")
        first = first[np.repeat(least, np.diff(begins, append=len(first))) < owner]
        marks[first] += 1
        marks[first + WINDOW] -= 1
    gone = np.cumsum(marks[:-1], dtype=np.int32) > 0
    if whole:
        gone = _whole_characters(data, gone)
    doc_ids, sizes, spans, kept = [], [], [], []
    start = 0
    for doc, end in zip(ids.tolist(), ends.tolist(), strict=True):
        own = gone[start:end]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
        doc_ids.append(None if doc == _NO_ID else doc)
        sizes.append(end - start)
        spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
        kept.append(data[start:end][~own].tobytes())
        start = end
    schema = _kept_schema(carried.schema)
    own = [pa.array(c, f.type) for c, f in zip((doc_ids, sizes, spans, kept), schema, strict=False)]
    return pa.table([*own, *carried.columns], schema=schema)


def dedup(docs: DataFrame, *, stored: bool = False, carry: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """(doc_id, n_bytes, spans, kept, and the columns of ``carry``) of every row of (doc_id, text).

    spans are the maximal runs of removed bytes, [start, end): those covered by a string of
    WINDOW bytes that also starts in a document with a smaller doc_id. kept is what
    remains, as bytes; a span may begin or end inside a character unless ``whole``, which
    removes such a character entirely. Null texts are empty; rows of one id do not thin each
    other; a null id comes after all others. ``docs`` is read twice and must give the same
    rows in the same tasks both times, as a stored table does (``stored``); anything else
    is written to the shared folder first.
    """
    ship_package(docs.sparkSession)
    # Carried columns may have the names of the others.
    named = [F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *named)
    docs = docs if stored else materialize(docs, "texts")
    carried = docs.schema[2:]
    edges = _anchor_edges(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.mapInArrow(_pack_texts, "chunk long, n long, n_bytes long, block binary, carried binary")
    hashes = docs.select("doc_id", "text").mapInArrow(
        _send_hashes(edges), "bucket int, chunk long, n long, block binary"
    )
    repeated = hashes.groupBy("bucket").applyInArrow(_repeated, "chunk long, n long, block binary")
    stretches = (
        texts.groupBy("chunk")
        .cogroup(repeated.groupBy("chunk"))
        .applyInArrow(_send_stretches(edges), _SENT)
    )
    answers = stretches.groupBy("bucket").applyInArrow(_sort_stretches, _ANSWERED)
    out = T._parse_datatype_string("doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    kept = (
        texts.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_remove(whole), T.StructType([*out.fields, *carried]))
    )
    return kept.toDF("doc_id", "n_bytes", "spans", "kept", *carry)


def thin(docs: DataFrame, *, stored: bool = False) -> DataFrame:
    """``docs`` with repeated passages taken out of the texts, rows and other columns as they are.

    A character that loses a byte goes as a whole, so texts stay valid. n_chars, where
    there is such a column, is the new number of code points of a text that lost some. A
    null text stays null.
    """
    columns = docs.columns
    others = [c for c in columns if c != "text"]
    marked = docs.withColumn("_has_text", F.col("text").isNotNull())
    cut = dedup(marked, stored=stored, carry=(*others, "_has_text"), whole=True)
    # The operator's own columns come first; a carried one of the same name is the later one.
    names = [f"_c{i}" for i in range(len(others))]
    cut = cut.toDF("_id", "_bytes", "_spans", "_kept", *names, "_has_text")
    text = F.when(F.col("_has_text"), F.col("_kept").cast("string"))
    cut = cut.withColumn("_text", text)
    out = []
    for c in columns:
        if c == "text":
            out.append(F.col("_text").alias("text"))
            continue
        value = F.col(names[others.index(c)])
        if c == "n_chars":
            now = F.when(F.size("_spans") > 0, F.length("_text").cast(docs.schema["n_chars"].dataType))
            value = F.coalesce(now, value)
        out.append(value.alias(c))
    return cut.select(*out)
