"""Stable dev/test splits and stratified folds."""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.operators.ranking import with_hash_rank
from chartloom.session import materialize

SEED = 42
TEST_FRACTION = 0.20


def carried(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Previous assignments whose key still exists."""
    return previous.join(current.select("key"), "key", "left_semi")


def orphaned(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Previous assignments whose key is gone."""
    return previous.join(current.select("key"), "key", "left_anti")


def new_keys(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Current keys that have no assignment yet."""
    return current.select("key").distinct().join(previous.select("key"), "key", "left_anti")


def rarest_label(labels: DataFrame) -> DataFrame:
    """For each key, its label with the fewest keys overall (equal counts: least label).

    ``labels`` holds distinct (key, label_code).
    """
    sizes = labels.groupBy("label_code").agg(F.count("*").alias("size"))
    return (
        labels.join(sizes, "label_code")
        .groupBy("key")
        .agg(F.min(F.struct("size", "label_code")).alias("rarest"))
        .select("key", F.col("rarest.label_code").alias("stratum"))
    )


def stratified_folds(labels: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """(key, stratum, fold 1..k) for every labelled key.

    Keys are laid out by rarest label and, inside it, by seeded hash, then dealt to the
    folds in turn: every fold gets its share of each stratum, and fold sizes differ by
    at most one. The same keys always land in the same folds. The (key, stratum) table is
    written once, because ranking reads it twice.
    """
    strata = materialize(rarest_label(labels), "strata")
    ranked = with_hash_rank(strata, "key", group="stratum", seed=seed, rank="_rank", across_groups=True)
    return ranked.select("key", "stratum", (F.pmod(F.col("_rank") - 1, F.lit(k)) + 1).cast("int").alias("fold"))


def stratified_split(labels: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SEED) -> DataFrame:
    """(key, bucket) with one fold in round(1 / fraction) held out for test."""
    folds = stratified_folds(labels, round(1 / test_fraction), seed)
    return folds.select("key", F.when(F.col("fold") == 1, "test").otherwise("dev").alias("bucket"))


def _spread(n: int) -> int:
    """A step that visits 0..n-1 far apart: the largest number up to 0.618 n without a common factor."""
    return next(s for s in range(max(1, int(0.618 * n)), 0, -1) if gcd(s, n) == 1)


def level_quotas(counts: list[int], n: int, turn: int) -> list[int]:
    """How many of ``n`` keys each fold gets so that ``counts`` end as level as they can.

    Each key goes to the fold with the least so far; equal folds take turns, beginning
    with fold ``turn``.
    """
    k = len(counts)
    order = sorted(range(k), key=lambda f: (counts[f], (f - turn) % k))
    # The lowest folds rise together: the level is where n keys no longer lift one more fold.
    used = k
    while used > 1 and sum(counts[order[used - 1]] - counts[f] for f in order[:used]) > n:
        used -= 1
    level, rest = divmod(n + sum(counts[f] for f in order[:used]), used)
    first = sorted(order[:used], key=lambda f: (f - turn) % k)[:rest]
    return [level - counts[f] + (f in first) if f in order[:used] else 0 for f in range(k)]


def _placed(labels: DataFrame, seed: int) -> DataFrame:
    """(key, stratum, position, label_codes): each key's place, from 0, among those of its rarest label.

    Labels are listed from the rarest on. Inside a stratum keys lie by their next two
    labels, then by seeded hash, so that neighbours have most in common.
    """
    sizes = labels.groupBy("label_code").agg(F.count("*").alias("size"))
    listed = (
        labels.join(sizes, "label_code")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("size", "label_code"))).getField("label_code").alias("label_codes"))
    )
    near = [F.coalesce(F.get("label_codes", F.lit(i)), F.lit("")) for i in (1, 2)]
    keyed = listed.select(
        "key", F.get("label_codes", F.lit(0)).alias("stratum"), near[0].alias("second"), near[1].alias("third"), "label_codes"
    )
    keyed = materialize(keyed.withColumn("kin", F.concat_ws("\x1f", "stratum", "second", "third")), "label-lists")
    # At most one row per three labels, however many keys there are.
    before = Window.partitionBy("stratum").orderBy("second", "third").rowsBetween(Window.unboundedPreceding, -1)
    kin = keyed.groupBy("stratum", "second", "third", "kin").agg(F.count("*").alias("n"))
    kin = kin.select("kin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = with_hash_rank(keyed, "key", group="kin", seed=seed, rank="_rank").join(kin, "kin")
    placed = ranked.select("key", "stratum", (F.col("start") + F.col("_rank") - 1).alias("position"), "label_codes")
    # Rows of one stratum lie together, so that a round reads little else.
    return materialize(placed.repartitionByRange("stratum", "position").sortWithinPartitions("stratum"), "placed")


def iterative_folds(labels: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """(key, stratum, fold 1..k) for every labelled key, each label levelled in its turn.

    ``labels`` holds distinct (key, label_code). From the rarest label to the most common
    one, the keys that have the label and none before it are dealt so that the label's
    counts, with those of keys dealt before, end as level as they can. Keys of a stratum are spread over
    the folds by a step through their positions. Strata that share no label are
    dealt in one round; a round sends its quotas to the keys and brings back one count per
    label and fold, so the driver holds tables of the label vocabulary's size only.
    """
    spark = labels.sparkSession
    sizes = {r.label_code: r["count"] for r in labels.groupBy("label_code").count().collect()}
    order = sorted(sizes, key=lambda c: (sizes[c], c))
    placed = _placed(labels, seed)
    members = {r.stratum: r["count"] for r in placed.groupBy("stratum").count().collect()}
    shared = placed.select("stratum", F.explode("label_codes").alias("label_code")).distinct()
    meets: dict[str, list[str]] = {}
    for stratum, label in shared.where("stratum <> label_code").collect():  # at most one row per two labels
        meets.setdefault(label, []).append(stratum)
    rounds: dict[str, int] = {}
    for label in order:
        rounds[label] = 1 + max((rounds[s] for s in meets.get(label, ())), default=-1)
    counts = {label: [0] * k for label in order}
    schema = "stratum string, size long, step long, ends array<long>"
    dealt: list[tuple[str, int, int, list[int]]] = []

    def folds(plan: list) -> DataFrame:
        quotas = F.broadcast(spark.createDataFrame(plan, schema))  # a row per label
        place = F.expr("CAST(CAST(position AS DECIMAL(19, 0)) * step % size AS BIGINT)")
        fold = F.size(F.filter("ends", lambda e: e <= place)) + 1
        return placed.join(quotas, "stratum").select("key", "stratum", "label_codes", fold.cast("int").alias("fold"))

    last = max(rounds.values(), default=0)
    for number in range(last + 1):
        plan = []
        for turn, label in enumerate(order):
            if rounds[label] == number and (n := members.get(label)):
                quota = level_quotas(counts[label], n, turn % k)
                plan.append((label, n, _spread(n), [sum(quota[: f + 1]) for f in range(k)]))
        dealt += plan
        if plan and number < last:
            own = folds(plan).where(F.col("stratum").isin([p[0] for p in plan]))
            found = own.select(F.explode("label_codes").alias("label_code"), "fold").groupBy("label_code", "fold")
            for label, fold, n in found.count().collect():
                counts[label][fold - 1] += n
    return folds(dealt).select("key", "stratum", "fold")


def iterative_split(labels: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SEED) -> DataFrame:
    """(key, bucket) with one fold in round(1 / fraction) of ``iterative_folds`` held out for test."""
    folds = iterative_folds(labels, round(1 / test_fraction), seed)
    return folds.select("key", F.when(F.col("fold") == 1, "test").otherwise("dev").alias("bucket"))


def merge_split(previous: DataFrame, current: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """Carried assignments plus a stratified split of the new, labelled keys.

    New keys are not among the carried ones, so the merge is disjoint if those are; a
    previous split with a key in both buckets is an error.
    """
    fresh = labels.join(new_keys(previous, current), "key", "left_semi")
    kept = assert_disjoint(carried(previous, current).select("key", "bucket"))
    return kept.unionByName(stratified_split(fresh, seed=seed))


def overlapping_keys(split: DataFrame) -> DataFrame:
    """Keys assigned to more than one bucket."""
    return split.groupBy("key").agg(F.countDistinct("bucket").alias("n_buckets")).where("n_buckets > 1")


def assert_disjoint(split: DataFrame) -> DataFrame:
    if not overlapping_keys(split).isEmpty():
        raise ValueError("dev and test overlap")
    return split


def encounter_split(encounter_ids: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SEED) -> DataFrame:
    """(key, bucket): exactly floor(fraction * n) of the keys, first in seeded hash order, are test."""
    keys = materialize(encounter_ids.select("key").distinct(), "encounter-keys")
    n_test = keys.agg(F.floor(F.count("*") * test_fraction)).scalar()
    ranked = with_hash_rank(keys, "key", seed=seed, rank="_rank")
    return ranked.select("key", F.when(F.col("_rank") <= n_test, "test").otherwise("dev").alias("bucket"))


def split_report(previous: DataFrame, current: DataFrame, split: DataFrame, labels: DataFrame) -> DataFrame:
    """Totals of a merged split: size, carried, new, orphaned, unlabelled, codes seen in test only."""
    was = previous.select("key", F.col("bucket").alias("was"))
    now = split.select("key", F.col("bucket").alias("now"))
    here = current.select("key", F.lit(True).alias("here")).distinct()
    old, new, present = F.col("was"), F.col("now"), F.col("here")
    counts = (
        was.join(now, "key", "full")
        .join(here, "key", "full")
        .agg(
            F.count(new).alias("n_total"),
            F.count_if(new == "dev").alias("n_dev"),
            F.count_if(new == "test").alias("n_test"),
            F.count_if(old.isNotNull() & (new == "dev")).alias("n_carried_dev"),
            F.count_if(old.isNotNull() & (new == "test")).alias("n_carried_test"),
            F.count_if(old.isNull() & (new == "dev")).alias("n_new_dev"),
            F.count_if(old.isNull() & (new == "test")).alias("n_new_test"),
            F.count_if(old.isNotNull() & present.isNull()).alias("n_orphaned"),
            F.count_if(present & new.isNull()).alias("n_skipped_empty"),
        )
    )
    test_only = codes_test_not_dev(split, labels).agg(F.count("*")).scalar()
    return counts.withColumn("n_codes_only_in_test", test_only)


def codes_test_not_dev(split: DataFrame, labels: DataFrame) -> DataFrame:
    """Label codes found on test keys and on no dev key."""
    return (
        labels.join(split, "key")
        .groupBy("label_code")
        .agg(F.max((F.col("bucket") == "dev").cast("int")).alias("in_dev"))
        .where("in_dev = 0")
        .select("label_code")
    )


def fold_balance(folds: DataFrame, labels: DataFrame) -> DataFrame:
    """Keys per (label, fold): how evenly every label, not just the rarest, is spread."""
    return labels.join(folds.select("key", "fold"), "key").groupBy("label_code", "fold").agg(F.count("*").alias("n"))
