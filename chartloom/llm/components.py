"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.session import materialize

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as (a, b) rows; component is its least node.

    Loops, repeated edges and nulls are ignored; a node without an edge is not returned.
    Neighbours are only ever reduced to their minimum, so a hub is never gathered. Each
    round's edges are written to the shared folder, so a lost executor costs one round.
    """
    e = edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct()
    e = materialize(e, "edges")
    before = _state(e)
    for _ in range(MAX_ROUNDS):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (
            small.select("a", F.col("m").alias("b"))
            .unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        e = materialize(small, "edges")
        after = _state(e)
        if after == before:
            nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = after
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
