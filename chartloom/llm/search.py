"""Ranked lexical search, term at a time with a limited set of accumulators.

The documents are cut into chunks where they are read, and each chunk keeps its own posting
lists of the query terms. A chunk is searched item by item: terms are taken rarest first, a
term opens an accumulator for every document that has it, and once the most that the terms
left could add stays below the k-th best partial score no new accumulator is opened: only
those that survive are updated, exactly, by what is left. The k-th best score of the chunks
that a task has searched before counts as well. The best of all tasks are merged by a
bounded rank.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.blocks import packed, unpacked
from chartloom.llm.tokens import slices
from chartloom.session import materialize, ship_package

TOP = 20
CHUNK_BYTES = 8 << 20
# Query rows are searched in blocks of about so many bytes and rows; one block is held by
# the driver and each worker at a time.
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 20_000
# An accumulator beside which a list is so many times longer is looked up in it.
_PROBE = 8

# A-Z are lowered, other ASCII letters and digits and all bytes of non-ASCII characters stay,
# everything else separates.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_POSTINGS = "n_docs long, n_terms long, docs long, lists long, postings long, heads binary, block binary"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, repeats included; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


class Item(NamedTuple):
    """A query: its id, its terms' numbers and how often it has each."""

    item_id: int | None
    numbers: np.ndarray
    repeats: np.ndarray


def read_items(rows: list[tuple[int | None, str | None]]) -> tuple[list[Item], dict[bytes, int]]:
    """Items of (item_id, text) rows and the number of each term. Different texts of one id are one query."""
    counts: dict[int | None, Counter] = {}
    for item_id, text in rows:
        counts.setdefault(item_id, Counter()).update(terms(text))
    numbers = {t: i for i, t in enumerate(sorted({t for c in counts.values() for t in c}))}
    items = [
        Item(i, np.array([numbers[t] for t in c], np.int64), np.array(list(c.values()), np.int64))
        for i, c in counts.items()
        if c
    ]
    return items, numbers


def index(docs: DataFrame, numbers: dict[bytes, int], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Posting lists of the numbered terms, one row per chunk of ``docs`` (doc_id, text).

    ``n_docs`` and ``n_terms`` count documents with terms and all their terms. ``heads`` holds
    the numbers of the chunk's terms and their documents' count, ``block`` the documents (id,
    whether it is null, number of terms) and per posting the document's place and the term's
    count there.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            for rows in slices(batch, 1, chunk_bytes):
                ids, lengths, nulls = [], [], []
                of_term: list[int] = []
                at: list[int] = []
                n_docs = n_terms = 0
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                    words = terms(text.as_py())
                    n_docs += bool(words)
                    n_terms += len(words)
                    found = [t for t in map(number, words) if t is not None]
                    if found:
                        of_term += found
                        at += [len(ids)] * len(found)
                        ids.append(doc_id or 0)
                        nulls.append(doc_id is None)
                        lengths.append(len(words))
                # (term, document) in one number: sorted, equal neighbours are a term's count.
                keys = np.array(of_term, np.int64) << 32 | np.array(at, np.int64)
                keys, tf = np.unique(keys, return_counts=True)
                lists, df = np.unique(keys >> 32, return_counts=True)
                block = packed(
                    np.array(ids, np.int64),
                    np.array(nulls, np.uint8),
                    np.array(lengths, np.int64),
                    (keys & 0xFFFFFFFF).astype(np.uint32),
                    tf.astype(np.uint32),
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "n_docs": [n_docs],
                        "n_terms": [n_terms],
                        "docs": [len(ids)],
                        "lists": [len(lists)],
                        "postings": [len(keys)],
                        "heads": [packed(lists, df)],
                        "block": [block],
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _POSTINGS)


def document_counts(postings: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents have each numbered term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                lists, df = unpacked(row["heads"], ("<i8", row["lists"]), ("<i8", row["lists"]))
                total[lists] += df
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "df"])

    rows = postings.select("lists", "heads").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df"))
    out = np.zeros(n_terms, np.int64)
    for term, df in rows.collect():  # at most one row per query term
        out[term] = df
    return out


class Chunk:
    """Posting lists of one chunk with what each posting is worth before its term's weight."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        lists, df = unpacked(row["heads"], ("<i8", row["lists"]), ("<i8", row["lists"]))
        d, p = row["docs"], row["postings"]
        self.ids, self.nulls, lengths, self.at, tf = unpacked(
            row["block"], ("<i8", d), ("u1", d), ("<i8", d), ("<u4", p), ("<u4", p)
        )
        self.size = d
        ends = np.cumsum(df)
        self.cut = {t: slice(e - n, e) for t, e, n in zip(lists.tolist(), ends.tolist(), df.tolist(), strict=True)}
        m = 75 + (25 * n_docs * lengths) // n_terms
        tf = tf.astype(np.int64)
        self.worth = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.at])
        most = np.maximum.reduceat(self.worth, ends - df) if p else np.zeros(0, np.int64)
        self.most = dict(zip(lists.tolist(), most.tolist(), strict=True))


def kth_best(scores: np.ndarray, k: int) -> int:
    """The k-th largest of the scores, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def accumulate(
    chunk: Chunk, terms_: list[tuple[int, int]], scores: np.ndarray, k: int, floor: int
) -> tuple[np.ndarray, int]:
    """Add an item's terms, (number, weight with repeats) rarest first, to ``scores`` (zeros, one per document).

    Returns the places of the documents with an accumulator and how many terms opened some.
    No document left out can reach ``floor`` or be among the chunk's k best.
    """
    use = [(t, w) for t, w in terms_ if w and t in chunk.cut]
    left = sum(w * chunk.most[t] for t, w in use)
    opened = 0
    for t, w in use:
        if left < floor or (opened and left < max(floor, kth_best(scores[scores > 0], k))):
            break
        cut = chunk.cut[t]
        scores[chunk.at[cut]] += w * chunk.worth[cut]
        left -= w * chunk.most[t]
        opened += 1
    live = np.flatnonzero(scores)
    for t, w in use[opened:] if len(live) else ():
        cut = chunk.cut[t]
        at, worth = chunk.at[cut], chunk.worth[cut]
        if _PROBE * len(live) < len(at):
            place = np.minimum(np.searchsorted(at, live), len(at) - 1)
            hit = at[place] == live
            scores[live[hit]] += w * worth[place[hit]]
        else:
            hit = scores[at] > 0
            scores[at[hit]] += w * worth[hit]
    return live, opened


class Best:
    """The k best documents seen so far: by score, then by doc_id, null last."""

    def __init__(self, k: int):
        self.k = k
        self.rows = (np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64))

    @property
    def floor(self) -> int:
        """No document below this score is among the best."""
        return int(self.rows[0][-1]) if len(self.rows[0]) == self.k else 1

    def add(self, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        low = max(self.floor, kth_best(scores, self.k))
        use = scores >= low
        merged = [np.concatenate(c) for c in zip(self.rows, (scores[use], nulls[use], ids[use]), strict=True)]
        order = np.lexsort((merged[2], merged[1], -merged[0]))[: self.k]
        self.rows = tuple(c[order] for c in merged)


def _search_block(docs: DataFrame, rows: list, k: int, chunk_bytes: int) -> DataFrame | None:
    items, numbers = read_items(rows)
    if not items:
        return None
    postings = materialize(index(docs, numbers, chunk_bytes), "postings")
    n_docs, n_terms = postings.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not n_docs:
        return None
    df = document_counts(postings, len(numbers)).tolist()
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df]
    plan = []
    for item in items:
        own = sorted(zip(item.numbers.tolist(), item.repeats.tolist(), strict=True), key=lambda x: (df[x[0]], x[0]))
        plan.append((item.item_id, [(t, n * weights[t]) for t, n in own]))
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in shared.value]
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, n_docs, n_terms)
                scores = np.zeros(chunk.size, np.int64)
                for (_, terms_), found in zip(shared.value, best, strict=True):
                    live, _ = accumulate(chunk, terms_, scores, k, found.floor)
                    found.add(scores[live], chunk.nulls[live], chunk.ids[live])
                    scores[live] = 0
        for (item_id, _), found in zip(shared.value, best, strict=True):
            scores, nulls, ids = found.rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([item_id] * len(scores), pa.int64()),
                    pc.if_else(pa.array(nulls == 0), pa.array(ids), None),
                    pa.array(scores),
                ],
                ["item_id", "doc_id", "score"],
            )

    found = postings.select("docs", "lists", "postings", "heads", "block")
    return found.mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): per row of ``items`` (item_id, text) its k best of ``docs`` (doc_id, text).

    Only scores above 0 count; equal ones go by ascending doc_id, null last. Every row of
    ``docs`` is a document of its own, repeated rows as well; a null or empty text has no
    terms. Equal rows of ``items`` are one query, different texts of one id (null too) are
    read as one text. An item without terms, or without a document, has no rows. Items are
    searched in blocks of BLOCK_BYTES or BLOCK_ROWS, so neither table has to be small; a
    single item's text has to fit in memory.
    """
    spark = docs.sparkSession
    queries = items.select(F.col("item_id").cast("long"), "text").distinct()
    size, count = queries.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    blocks = max(1, -(-(size or 0) // BLOCK_BYTES), -(-count // BLOCK_ROWS))
    block = F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(-1))), F.lit(blocks))
    out = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for b in range(blocks):
        found = _search_block(docs, [tuple(r) for r in queries.where(block == b).collect()], k, chunk_bytes)
        out = out if found is None else out.unionByName(found)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
