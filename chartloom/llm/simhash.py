"""SimHash near-duplicates found through a byte-position inverted index.

Two 64-bit fingerprints that differ in at most two bits agree in at least six of their
eight bytes. The index keys a fingerprint by two of its four byte pairs: whatever two
bytes differ, one such key survives, so every link shares a posting list. Pairs of a list
are tallied by the positional bytes they share, kept from six on, then verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.components import connected
from chartloom.session import materialize, ship_package

BITS = 2
MIN_SHARED_BYTES = 6
SEED = 42
SHINGLE = 3
# Posting lists up to this length are paired within; longer ones are linked through
# one-bit neighbours instead, which finds the same components without pairing the list.
PAIR_LIST = 32
_BLOCK = 1 << 15


def simhash(text: str | None) -> int:
    """64-bit fingerprint of a text; 0 for one without words.

    A-Z are lowered, words are runs of other than ASCII white space, shingles are three
    words joined by a space (the whole sequence if shorter), repeats included. A bit is 1
    if more than half the shingles' XXH64 have it.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _BLOCK):
        part = words[start : start + _BLOCK + SHINGLE - 1]
        if len(words) < SHINGLE:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(part, part[1:], part[2:], strict=False))
        hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_simhash(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, the fingerprint as a signed long."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([simhash(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _byte_pair(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))


def _shared_bytes(a: Column, b: Column) -> Column:
    differ = a.bitwiseXOR(b)
    shared = F.lit(0)
    for i in range(8):
        shared = shared + F.when(F.shiftrightunsigned(differ, 8 * i).bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0)
    return shared


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints as all links of at most two bits do.

    ``prints`` has one row per fingerprint, ``fp``. In lists of up to PAIR_LIST members
    every link is an edge. Members of longer lists are joined to their 64 one-bit
    neighbours and themselves: two of them are within two bits exactly if they share one,
    and each is tied to the least member there.
    """
    keys = F.array(
        *[
            F.struct(
                F.lit(n).alias("kind"),
                F.shiftleft(_byte_pair(F.col("fp"), i), 16).bitwiseOR(_byte_pair(F.col("fp"), j)).alias("bytes"),
            )
            for n, (i, j) in enumerate(combinations(range(4), 2))
        ]
    )
    postings = prints.select("fp", F.inline(keys))
    sizes = postings.groupBy("kind", "bytes").count().where("count > 1")
    listed = materialize(postings.join(sizes, ["kind", "bytes"]), "postings")
    short = listed.where(F.col("count") <= PAIR_LIST).select("kind", "bytes", "fp")
    pairs = (
        short.withColumnRenamed("fp", "a")
        .join(short.withColumnRenamed("fp", "b"), ["kind", "bytes"])
        .where("a < b")
        .where(_shared_bytes(F.col("a"), F.col("b")) >= MIN_SHARED_BYTES)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS)
        .select("a", "b")
    )
    long = listed.where(F.col("count") > PAIR_LIST).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    near = long.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("at"))
    tied = near.groupBy("at").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top").select("at", "b")
    dense = near.join(tied, "at").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(dense).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Equal fingerprints are one node however many documents have them; the fingerprint 0 of
    texts without words is linked like any other. component_id is the least doc_id
    reachable. A null doc_id keeps its row but does not name a component; a component of
    nothing else has null. Repeated rows are repeated in the result.
    """
    prints = materialize(with_simhash(docs), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = connected(fingerprint_links(nodes.select("fp")))
    named = nodes.join(groups, nodes["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = named.join(least, "component").select("fp", "component_id")
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate group: the one with the least doc_id.

    Rows that share that id: one stays. Rows without an id cannot be told apart by it and
    all stay.
    """
    kept = near_duplicates(docs.where("doc_id is not null")).where("doc_id = component_id").select("doc_id").distinct()
    # Groups here are rows of one id, so nothing larger than a repeated row is compared.
    named = docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    return named.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))
