"""Bottom-k sketches of word shingles, in DataFrame functions only.

A sketch is the k least distinct hashes of a text's five-word shingles, ascending.
Sketches of parts merge into the sketch of the whole, and two sketches estimate
resemblance, containment and distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
K = 128
HEX_DIGITS = 12
# Documents whose ids agree above this many low bits are put in order by one task.
ID_BITS = 10


def with_sketch(df: DataFrame, text: Column, name: str, *, k: int = K) -> DataFrame:
    """Add the sketch of ``text`` as array<long> ``name``.

    Words are runs of other than ASCII white space; a shingle is five of them. A shorter
    text has one shingle, its whole word sequence; without words (null, empty, blank) the
    sketch is empty.
    """
    w, p2, p4, p5 = (f"_{name}_{part}" for part in ("w", "p2", "p4", "p5"))
    end = 1 << 30  # longer than any array; start + length must not overflow
    # Each step is a column of its own: a lambda that refers to an expression would evaluate
    # it again for every element. Past the end a step hashes what is left, so only a text
    # shorter than a shingle keeps such a value, that of its whole sequence.
    split = F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+"), "")
    df = df.withColumn(w, F.transform(split, lambda word: F.xxhash64(word)))
    df = df.withColumn(p2, F.zip_with(w, F.slice(w, 2, end), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn(p4, F.zip_with(p2, F.slice(p2, 3, end), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn(p5, F.zip_with(p4, F.slice(w, 5, end), lambda a, b: F.xxhash64(a, b)))
    whole = F.slice(p5, F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1)))
    return df.withColumn(name, F.slice(F.sort_array(F.array_distinct(whole)), 1, k)).drop(w, p2, p4, p5)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; exact when both sets have at most k members; 1.0 for two empty ones."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.get(a, F.lit(k - 1)).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    full = F.lit(float(k - 1)) / share
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(full)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds; 1.0 for an empty a."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def encoded(sketch: Column) -> Column:
    """The sketch as text, the leading 12 hex digits of each hash."""
    digits = F.transform(sketch, lambda h: F.substring(F.lpad(F.hex(h), 16, "0"), 1, HEX_DIGITS))
    return F.lower(F.array_join(digits, ""))


def merge_sketches(df: DataFrame, keys: list[str], sketch: str, *, k: int = K) -> DataFrame:
    """One sketch per key from sketches of its parts.

    Hashes are made distinct and ranked per key with a bounded ``row_number``, which Spark
    also applies before the shuffle: a hot key sends at most k hashes a task.
    """
    hashes = df.select(*keys, F.explode(sketch).alias("_h"))
    order = Window.partitionBy(*keys).orderBy("_h")
    kept = hashes.withColumn("_rank", F.dense_rank().over(order)).where(F.col("_rank") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_set("_h")).alias(sketch))


def with_next(df: DataFrame, id_column: str, carried: list[str], tie: list[str], *, id_bits: int = ID_BITS) -> DataFrame:
    """Add ``next_<c>`` of the following row for each carried column, ascending by id, then ``tie``.

    After the last row comes the first. Rows go to groups of neighbouring ids, where the
    order is local; each group's last row gets the next group's first one by a join of
    those few rows. Null ids come first. Groups hold at most 2**id_bits different ids.
    """
    group = F.shiftright(F.coalesce(F.col(id_column), F.lit(-(2**63))), id_bits)
    rows = df.withColumn("_group", group)
    inside = Window.partitionBy("_group").orderBy(id_column, *tie)
    rows = rows.withColumns(
        {
            **{f"next_{c}": F.lead(c).over(inside) for c in carried},
            "_more": F.lead(F.lit(True)).over(inside),
            "_after": F.lag(F.lit(True)).over(inside),
        }
    )
    firsts = rows.where(F.col("_after").isNull()).select(
        F.col("_group").alias("_next"), *[F.col(c).alias(f"next_{c}") for c in carried]
    )
    lasts = rows.where(F.col("_more").isNull()).drop(*[f"next_{c}" for c in carried])
    follows = _following(df.select(group.alias("_group")).distinct())
    joined = lasts.join(follows, "_group").join(firsts, "_next")
    plain = rows.where(F.col("_more").isNotNull())
    return plain.unionByName(joined.select(plain.columns)).drop("_group", "_more", "_after")


def _following(groups: DataFrame, bits: int = 12) -> DataFrame:
    """(_group, _next): the next greater group of each; the least after the greatest.

    Ordered inside spans of groups first; only one row per span goes to a single task.
    """
    spans = groups.withColumn("_span", F.shiftright("_group", bits))
    inside = Window.partitionBy("_span").orderBy("_group")
    spans = spans.withColumn("_next", F.lead("_group").over(inside))
    firsts = spans.groupBy("_span").agg(F.min("_group").alias("_first"))
    over = Window.orderBy("_span")
    least = F.min("_first").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ahead = firsts.select("_span", F.coalesce(F.lead("_first").over(over), least).alias("_ahead"))
    return spans.join(ahead, "_span").select("_group", F.coalesce("_next", "_ahead").alias("_next"))


def edited(text: Column, n_chars: Column, following: Column) -> Column:
    """The last half (rounded down) of ``text`` replaced by as many first code points of ``following``."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n_chars - half).cast("int")), F.substring(following, F.lit(1), half))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    Null texts are empty. Documents with one id go by text. A single document follows
    itself. Other columns are ignored.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = with_next(with_sketch(base, F.col("text"), "own"), "doc_id", ["text", "own"], ["text"])
    base = base.withColumn("n_chars", F.length("text").cast("long"))
    base = base.withColumn("edited", edited(F.col("text"), F.col("n_chars"), F.col("next_text")))
    return with_sketch(base, F.col("edited"), "changed").select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        encoded(F.col("own")).alias("fingerprint"),
        encoded(F.col("changed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
        resemblance(F.col("own"), F.col("next_own")).alias("near_next"),
    )
