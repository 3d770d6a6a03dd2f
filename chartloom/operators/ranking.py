"""Exact ranks and samples in hash order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions.keys import seeded_hash

# Above this size a hash sample is cut by rank instead of by a driver-side top-k.
TOP_K_LIMIT = 10_000


def with_hash_rank(
    df: DataFrame,
    key: str,
    *,
    group: str | None = None,
    seed: int | str | None = None,
    hex_digits: int = 3,
    rank: str = "hash_rank",
    across_groups: bool = False,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add the 1-based rank of each row by ``md5(seed:key)``, per ``group`` or overall.

    A plain ``row_number`` would sort each group in one task, so a group holding a third
    of the rows would sink the job. Here the leading hex digits of the hash cut every
    group into 16**hex_digits even slices: slice sizes give each slice's starting rank,
    and rows are only ordered inside their slice. ``key``, or ``key`` with ``ties``, must be unique in its group.

    With ``across_groups`` the rank continues from one group (ascending) to the next.
    """
    slices = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    keyed = df.withColumns(
        {
            "_group": F.col(group) if group else F.lit(""),
            "_hash": seeded_hash(F.col(key), seed),
        }
    ).withColumn("_slice", F.substring("_hash", 1, hex_digits))
    sizes = keyed.groupBy("_group", "_slice").agg(F.count("*").alias("_size"))
    starts = sizes.select("_group", "_slice", F.coalesce(F.sum("_size").over(slices), F.lit(0)).alias("_start"))
    if group and across_groups:
        # One row per group: bounded by the label vocabulary, so a global window is small.
        earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
        group_starts = (
            sizes.groupBy("_group")
            .agg(F.sum("_size").alias("_total"))
            .select("_group", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_group_start"))
        )
        starts = starts.join(group_starts, "_group").select(
            "_group", "_slice", (F.col("_start") + F.col("_group_start")).alias("_start")
        )
    in_slice = Window.partitionBy("_group", "_slice").orderBy("_hash", key, *ties)
    return (
        keyed.join(starts, ["_group", "_slice"])
        .withColumn(rank, F.col("_start") + F.row_number().over(in_slice))
        .drop("_group", "_slice", "_hash", "_start")
    )


def hash_sample(
    df: DataFrame, key: str, n: int | Column, *, seed: int | str | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` rows that come first in hash order; ``n`` may be a scalar-subquery column.

    Rows of one key follow each other in the order of ``ties``.
    """
    if isinstance(n, int) and n <= TOP_K_LIMIT:
        return df.orderBy(seeded_hash(F.col(key), seed), key, *ties).limit(n)
    ranked = with_hash_rank(df, key, seed=seed, rank="_sample_rank", ties=ties)
    return ranked.where(F.col("_sample_rank") <= n).drop("_sample_rank")


def first_by(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key in ``order``.

    Spark turns the bounded ``row_number`` filter into a group limit that runs before the
    shuffle as well as after it, so a hot key sends at most ``n`` rows per map task.
    """
    name = rank or "_rn"
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return kept if rank else kept.drop(name)
