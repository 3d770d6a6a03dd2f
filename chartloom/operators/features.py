"""TF-IDF features as DataFrames.

Layout: notes are spread while they are still plain text and split into tokens by generated
code. N-grams are counted batch by batch where the note is, and leave the task as what is
asked for: counts per term, already added up over the batch, or one sparse vector per note.
Exploded n-grams are never rows; only vocabulary counts are shuffled. Every row of ``notes``
is a note of its own, whatever its id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions import text as tx
from chartloom.operators import ngrams as ng
from chartloom.session import ship_package


@dataclass(frozen=True)
class Block:
    """One family of n-grams and its size limits."""

    name: str
    low: int
    high: int
    min_df: int = 2
    max_df: float = 0.95
    max_features: int = 20_000


WORD = Block("word", 1, 2)
CHAR = Block("char", 3, 5)
BLOCKS = (WORD, CHAR)


def spread(notes: DataFrame, *columns: str) -> DataFrame:
    """Columns of the notes, in partitions that the text's size decides.

    Small ones are merged and large ones split by the engine at run time, so neither a
    few large files nor a hot note id makes one task do the work.
    """
    return notes.select(*columns, "note_text").hint("rebalance", "note_id")


def _tokens(block: Block) -> Column:
    text = F.col("note_text")
    return tx.word_tokens(text) if block.name == WORD.name else tx.spaced_words(text)


def _count(tokens: pa.ListArray, block: Block, known: pa.Array | None = None) -> ng.Counts:
    count = ng.word_counts if block.name == WORD.name else ng.char_counts
    return count(tokens, block.low, block.high, known)


def _mapped(notes: DataFrame, schema: str, run: Callable[[pa.RecordBatch], pa.RecordBatch], block: Block) -> DataFrame:
    """``run`` over slices of the notes; the last column holds the tokens, those of ``block``, that bound a slice."""
    ship_package(notes.sparkSession)
    last = len(notes.columns) - 1
    limit = ng.SLICE_WORDS if block.name == WORD.name else ng.SLICE_TOKENS

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ng.slices(batch, last, limit):
                yield run(part)

    return notes.mapInArrow(each, schema)


def term_counts(notes: DataFrame, block: Block) -> DataFrame:
    """(note_id, term, tf)."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        found = _count(part.column(1), block)
        columns = [part.column(0).take(pa.array(found.note)), found.terms.take(pa.array(found.term)), pa.array(found.tf)]
        return pa.RecordBatch.from_arrays(columns, ["note_id", "term", "tf"])

    kind = notes.schema["note_id"].dataType.simpleString()
    tokens = spread(notes, "note_id").select("note_id", _tokens(block).alias("tokens"))
    return _mapped(tokens, f"note_id {kind}, term string, tf long", run, block)


def document_frequencies(notes: DataFrame, block: Block, by: str | None = None) -> DataFrame:
    """(term, df, cf): notes holding the term, and its occurrences in all; per value of an integer column ``by``."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        found = _count(part.column(1), block)
        width = max(1, len(found.terms))
        place = found.term
        if by:
            groups, group = np.unique(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), return_inverse=True)
            place = group[found.note] * width + place
        else:
            groups = np.zeros(1, np.int64)
        df = np.bincount(place)
        at = np.flatnonzero(df)
        columns = [
            pa.array(groups[at // width]),
            found.terms.take(pa.array(at % width)),
            pa.array(df[at]),
            pa.array(np.bincount(place, weights=found.tf)[at].astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["_by", "term", "df", "cf"])

    group = F.coalesce(F.col(by).cast("long"), F.lit(0).cast("long")) if by else F.lit(0).cast("long")
    tokens = spread(notes, "note_id", *([by] if by else [])).select(group.alias("_by"), _tokens(block).alias("tokens"))
    keys = [F.col("_by").alias(by)] if by else []
    counted = _mapped(tokens, "_by long, term string, df long, cf long", run, block)
    return counted.groupBy(*keys, "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def vocabulary(notes: DataFrame, block: Block) -> DataFrame:
    """(term, feature_id, df, cf, idf) of the block's vocabulary over ``notes``.

    Terms in fewer than ``min_df`` notes or in more than a ``max_df`` share of them are
    dropped; of the rest the ``max_features`` most frequent stay (equal counts: least
    term). Feature ids follow term order. The result is at most ``max_features`` rows.
    """
    n_notes = notes.agg(F.count("*")).scalar()
    kept = (
        document_frequencies(notes, block)
        .where((F.col("df") >= block.min_df) & (F.col("df") <= n_notes * block.max_df))
        .orderBy(F.desc("cf"), "term")
        .limit(block.max_features)
    )
    return kept.select(
        "term",
        (F.row_number().over(Window.orderBy("term")) - 1).alias("feature_id"),
        "df",
        "cf",
        idf(n_notes, F.col("df")).alias("idf"),
    )


def idf(n_notes, df):
    """Smoothed inverse document frequency."""
    return F.ln((n_notes + 1) / (df + 1)) + 1


def block_offsets(blocks=BLOCKS) -> dict[str, int]:
    """First feature id of each block in the joint feature space."""
    offsets, start = {}, 0
    for block in blocks:
        offsets[block.name] = start
        start += block.max_features
    return offsets


def fit_vocabularies(notes: DataFrame, blocks=BLOCKS) -> DataFrame:
    """(block, term, feature_id, df, cf, idf) for all blocks."""
    parts = [vocabulary(notes, block).withColumn("block", F.lit(block.name)) for block in blocks]
    joint = parts[0]
    for part in parts[1:]:
        joint = joint.unionByName(part)
    return joint.select("block", "term", "feature_id", "df", "cf", "idf")


def known_counts(notes: DataFrame, terms: DataFrame, blocks=BLOCKS) -> DataFrame:
    """(note_id, terms, counts): ids and occurrences of the (block, term, id) listed, one row per note, ids ascending.

    The list is brought to every task: it is a vocabulary, or the vocabularies of some folds, cut to
    ``max_features`` terms each.
    """
    return _known(notes, terms, blocks, lambda counts: counts[2], _as_rows(pa.int64()), lambda kind: f"note_id {kind}, terms array<int>, counts array<long>")


def _as_rows(value_type: pa.DataType) -> Callable[..., pa.RecordBatch]:
    def rows(note_id: pa.Array, ends: np.ndarray, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        ends = pa.array(ends.astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(values, value_type))]
        return pa.RecordBatch.from_arrays([note_id, *lists], ["note_id", "terms", "counts"])

    return rows


def _known(notes: DataFrame, terms: DataFrame, blocks, finish, give, schema: Callable[[str], str]) -> DataFrame:
    """What ``give`` makes of slices of notes: their ids, and as sparse rows the known terms and their values.

    ``give`` takes note ids, the bounds of each note's terms, the terms' ids (ascending in a note) and the values
    that ``finish`` makes of a block's (note, id, tf, number of notes). ``schema`` is given the type of note ids.
    """
    listed = terms.select("block", "term", "id").toArrow().sort_by("id")
    tables = []
    for block in blocks:
        own = listed.filter(pc.equal(listed["block"], block.name))
        tables.append((own["term"].combine_chunks(), own["id"].to_numpy().astype(np.int64)))
    # Ids of one block come in order; if all of a block's are below the next block's, notes alone have to be ordered.
    ranges = [(number[0], number[-1]) for _, number in tables if len(number)]
    apart = all(last < first for (_, last), (first, _) in pairwise(ranges))
    shared = notes.sparkSession.sparkContext.broadcast(tables)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        note, ids, values = [], [], []
        for i, block in enumerate(blocks):
            known, number = shared.value[i]
            found = _count(part.column(1 + i), block, known)
            note.append(found.note)
            ids.append(number[found.term])
            values.append(finish((found.note, ids[-1], found.tf, part.num_rows)))
        note, ids, values = (np.concatenate(c) for c in (note, ids, values))
        order = np.argsort(note, kind="stable") if apart else np.lexsort((ids, note))
        ends = np.concatenate(([0], np.cumsum(np.bincount(note, minlength=part.num_rows))))
        return give(part.column(0), ends, ids[order], values[order])

    kind = notes.schema["note_id"].dataType.simpleString()
    tokens = spread(notes, "note_id").select("note_id", *(_tokens(block).alias(block.name) for block in blocks))
    return _mapped(tokens, schema(kind), run, blocks[-1])


def feature_vectors(notes: DataFrame, vocabularies: DataFrame, blocks=BLOCKS) -> DataFrame:
    """(note_id, indices, values): one sparse row per note in the joint space, empty where no term is known.

    Sublinear TF-IDF; each block has unit length.
    """
    give = _as_rows(pa.float64())
    vectors = map_vectors(notes, vocabularies, give, lambda kind: f"note_id {kind}, terms array<int>, counts array<double>", blocks)
    return vectors.withColumnsRenamed({"terms": "indices", "counts": "values"})


def map_vectors(
    notes: DataFrame, vocabularies: DataFrame, give: Callable[..., pa.RecordBatch], schema: Callable[[str], str], blocks=BLOCKS
) -> DataFrame:
    """What ``give`` makes of the vectors of ``feature_vectors``, in the task that has just made them.

    ``give`` takes a slice's note ids and its sparse rows: bounds, indices, values.
    """
    offsets = block_offsets(blocks)
    start = F
    for name, first in offsets.items():
        start = start.when(F.col("block") == name, first)
    listed = vocabularies.select("block", "term", (F.col("feature_id") + start).alias("id"), "idf")
    weights = listed.select("id", "idf").toArrow()
    idf_of = np.zeros(sum(block.max_features for block in blocks))
    idf_of[weights["id"].to_numpy()] = weights["idf"].to_numpy()
    shared = notes.sparkSession.sparkContext.broadcast(idf_of)

    def weigh(counts) -> np.ndarray:
        note, ids, tf, n_notes = counts
        raw = (np.log(tf) + 1) * shared.value[ids]
        return raw / np.sqrt(np.bincount(note, weights=raw * raw, minlength=n_notes))[note]

    return _known(notes, listed, blocks, weigh, give, schema)


def tfidf(notes: DataFrame, vocab: DataFrame, block: Block) -> DataFrame:
    """(note_id, feature_id, weight): sublinear TF-IDF with unit length per note."""
    vectors = feature_vectors(notes, vocab.withColumn("block", F.lit(block.name)), (block,))
    return vectors.select("note_id", F.inline(F.arrays_zip("indices", "values"))).toDF("note_id", "feature_id", "weight")


def feature_rows(notes: DataFrame, vocabularies: DataFrame, blocks=BLOCKS) -> DataFrame:
    """(note_id, block, feature_id, weight) in the joint space; blocks keep their own unit length."""
    name = F
    for block, first in sorted(block_offsets(blocks).items(), key=lambda b: -b[1]):
        name = name.when(F.col("feature_id") >= first, block)
    vectors = feature_vectors(notes, vocabularies, blocks)
    rows = vectors.select("note_id", F.inline(F.arrays_zip("indices", "values"))).toDF("note_id", "feature_id", "weight")
    return rows.select("note_id", name.alias("block"), "feature_id", "weight")
