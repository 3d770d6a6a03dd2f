"""Best-fit packing of tokenised documents into sequences of a fixed size.

Pieces are ranged by length and numbered within their length where they are made, so no
task ever holds a length. Sweeps then go from the longest length down. In each, the pieces
of that length look for their successor among the gaps (the smallest gap that holds them);
rank decides which piece gets which gap; the gaps shrink and the next sweep begins. Pieces
of one length are interchangeable, and so are gaps of one size, so a sweep matches whole
runs of ranks with whole runs of sequences. Its state depends on the sequence size alone
(2,048 lengths), never on the number of documents, and the runs it yields place every
piece by its rank in a last distributed pass.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.tokens import WordEncoder, gather, slices, words_of
from chartloom.session import materialize, ship_package

CAPACITY = 2048
END_ID = 0
# Texts tokenised at once.
SLICE_BYTES = 4 << 20
# White space ends words and is dropped, so a newline is as good as a space.
_LINE_END = " "
# A word of plain letters and what ASCII marks follow them are tokenised apart from each other.
_STEM = r"^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long"


class _Runs(NamedTuple):
    """Ids of words: those of run ``first`` and then those of run ``second`` of the runs that ``flat`` is made of."""

    flat: np.ndarray
    counts: np.ndarray
    first: np.ndarray
    second: np.ndarray


class _LowerEncoder(WordEncoder):
    """Encodes the lower-case stem and the tail of a plain word once each, other words whole.

    Words are split, lowered and told apart in bulk, so that only distinct stems and tails
    are looked up.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self._parts = WordEncoder(path, plain=True)

    def runs(self, words: pa.Array) -> _Runs:
        parts = pc.extract_regex(words, _STEM)
        plain = parts.is_valid()
        stems = pc.utf8_lower(pc.struct_field(parts, "stem")).drop_null().dictionary_encode()
        tails = pc.struct_field(parts, "tail").drop_null().dictionary_encode()
        others = words.filter(pc.invert(plain))
        found = [
            self._parts.lookup(stems.dictionary.to_pylist()),
            self._parts.lookup(tails.dictionary.to_pylist()),
            self.lookup(others.to_pylist()),
        ]
        start = np.cumsum([0, *(len(counts) for _, counts in found)])
        flat = np.concatenate([ids for ids, _ in found])
        counts = np.concatenate([*(counts for _, counts in found), [0]])  # the last run is empty
        plain = plain.to_numpy(zero_copy_only=False)
        first, second = np.empty(len(words), np.int64), np.full(len(words), len(counts) - 1)
        first[plain], second[plain] = stems.indices.to_numpy(), tails.indices.to_numpy() + start[1]
        first[~plain] = np.arange(len(others)) + start[2]
        return _Runs(flat, counts, first, second)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each begins; one more at the end)."""
        words, at, offsets = words_of(texts, _LINE_END)
        runs = self.runs(words)
        both = np.empty(2 * len(at), np.int64)
        both[::2], both[1::2] = runs.first[at], runs.second[at]
        ids, ends = gather(runs.flat, runs.counts, both)
        return ids, np.concatenate(([0], ends[1::2]))[offsets]


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> _LowerEncoder:
    """One encoder a worker process: its next task finds the words of the last one."""
    return _LowerEncoder(vocabulary)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text): the text's ids and END_ID, cut every ``capacity``.

    ``local_rank`` numbers the pieces of one length inside task ``part``. A null or empty
    text is END_ID alone.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in slices(batch, 1, SLICE_BYTES):
                ids, ends = encoder.ids(rows.column(1))
                out = []
                for doc, lo, hi in zip(rows.column(0).to_pylist(), ends, ends[1:], strict=False):
                    data = ids[lo:hi].tobytes() + END_ID.to_bytes(4, "little")
                    for piece, start in enumerate(range(0, len(data) // 4, capacity)):
                        cut = data[4 * start : 4 * (start + capacity)]
                        n = len(cut) // 4
                        out.append((doc, piece, start, n, zlib.crc32(cut), part, seen[n]))
                        seen[n] += 1
                columns = zip(*out, strict=True)
                kinds = ("int64", "int32", "int64", "int64", "int64", "int32", "int64")
                names = [c.split()[0] for c in _PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[pd.DataFrame, int]:
    """Best-fit-decreasing for ``counts`` pieces per length: runs of placements, and the sequences used.

    In a run, the piece of rank lo + j (j < size) goes to sequence first + j // per at
    offset + (j % per) * length.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, sequences)
    sizes: list[int] = []  # gaps at hand, ascending
    runs: list[tuple[int, int, int, int, int, int]] = []
    used = 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            i = bisect.bisect_left(sizes, length)
            if i < len(sizes):
                gap = sizes[i]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[i]
            else:
                gap, first, n = capacity, used, -(-left // (capacity // length))
                used += n
            per = gap // length
            full = min(n, left // per)
            placed = full * per
            if full:
                runs.append((length, rank, placed, first, per, capacity - gap))
                add(gap - per * length, first, full)
            rest = min(left - placed, per - 1) if full < n else 0
            if rest:
                runs.append((length, rank + placed, rest, first + full, rest, capacity - gap))
                add(gap - rest * length, first + full, 1)
                full += 1
            add(gap, first + full, n - full)
            rank += placed + rest
            left -= placed + rest
    return pd.DataFrame(runs, columns=["length", "lo", "size", "first", "per", "offset"]), used


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` with sequence_id and offset, gapless from 0 in each sequence.

    Every row is a document of its own, also a repeated one or one without an id; no rows
    give no pieces. Pieces are written once to the shared folder, so texts are tokenised once.
    """
    pieces = materialize(token_pieces(docs, vocabulary, capacity), "pieces")
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan, _ = sweep(counts, capacity)
    plan = plan.sort_values(["length", "lo"])
    # Runs number a few times the sequence size, whatever the number of pieces.
    shared = docs.sparkSession.sparkContext.broadcast(plan.to_numpy(np.int64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        lengths = runs[:, 0]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            found = np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                lo, hi = np.searchsorted(lengths, [n, n + 1])
                found[own] = lo + np.searchsorted(runs[lo:hi, 1], rank[own], side="right") - 1
            run = runs[found]
            j = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(run[:, 3] + j // run[:, 4]),
                    pa.array(run[:, 5] + (j % run[:, 4]) * length),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(starts, ["length", "part"]).withColumn("rank", F.col("first_rank") + F.col("local_rank"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
