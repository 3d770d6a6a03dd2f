"""Prefix trie of conversations, its subtree totals gathered by time-forward processing.

A node is a sequence of first turns, known by its depth and 128 bits of hash that are
combined turn by turn. Nodes are dealt to shards by their first turn; a first turn that
very many rows begin with is dealt by conversation too, and a shard then has its own copy of
the nodes that it shares with others. A conversation of more than BAND turns is cut into
bands of depths, a shard each. In a shard the nodes are sorted from the deepest level up.
Each adds what its children sent to its own value and sends the sum on to its parent through a
priority queue that spills sorted runs. What leaves a shard at its roots is added up across
shards: copies of a node by its key, bands by the conversations that run through them.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.session import materialize, ship_package

# Rows a shard has, about; first turns that more rows begin with are dealt by conversation.
SHARD_ROWS = 200_000
# Depths that one shard holds of a conversation.
BAND = 10_000
# Turns that a window numbers at once; a longer conversation is numbered in stretches.
STRETCH = 10_000
# Messages that a queue keeps in memory.
QUEUE_ROWS = 1 << 18
# Nodes with more children are joined to them apart.
MANY_CHILDREN = 10_000
# Tables up to so many rows of a few numbers are broadcast.
FEW_ROWS = 500_000
# Bits of a conversation's id that one text of member ids spans.
_ID_BLOCK = 16

_KEY = ["depth", "a", "b"]


# --- turns and rebuilt conversations --------------------------------------------------


def _running(df: DataFrame, stretch: Column, order: list[Column], values: dict[str, Column], how) -> DataFrame:
    """Add running totals (``how``: a sum or an exclusive or) of ``values`` per conversation in ``order``.

    ``stretch`` must not fall along the order. Totals are formed per (conversation, stretch)
    and stretch by stretch, so that a conversation with very many turns is no single task.
    """
    cut = df.withColumn("_stretch", stretch)
    within = Window.partitionBy("conv_id", "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumns({n: how(v).over(within) for n, v in values.items()})
    totals = df.withColumn("_stretch", stretch).groupBy("conv_id", "_stretch")
    totals = totals.agg(*(how(v).alias(f"_{n}") for n, v in values.items()), F.count("*").alias("_n"))
    several = Window.partitionBy("conv_id")
    before = several.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("_stretches", F.count("*").over(several)).where("_stretches > 1")
    starts = starts.select("conv_id", "_stretch", *(how(F.col(f"_{n}")).over(before).alias(f"_{n}") for n in values))
    joined = cut.join(starts, ["conv_id", "_stretch"], "left")
    for n in values:
        both = F.array(F.coalesce(n, F.lit(0).cast("long")), F.coalesce(f"_{n}", F.lit(0).cast("long")))
        if how is F.bit_xor:
            total = F.element_at(both, 1).bitwiseXOR(F.element_at(both, 2))
        else:
            total = F.element_at(both, 1) + F.element_at(both, 2)
        joined = joined.withColumn(n, total)
    return joined.drop("_stretch", *(f"_{n}" for n in values))


def numbered_turns(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(conv_id, j, x, y, n_chars): turns counted from 0 in their order, with two hashes of role and text.

    Turns go by turn, null first, then by role and text. Null roles and texts are empty;
    rows without conv_id belong to no conversation and are left out.
    """
    rows = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    place = F.coalesce(F.floor(F.col("turn") / stretch).cast("long"), F.lit(-(1 << 63)).cast("long"))
    placed = _running(rows, place, order, {"j": F.lit(1).cast("long")}, F.sum)
    return placed.select(
        "conv_id",
        (F.col("j") - 1).alias("j"),
        F.xxhash64(F.lit(1), "role", "text").alias("x"),
        F.xxhash64(F.lit(2), "text", "role").alias("y"),
        F.length("text").cast("long").alias("n_chars"),
    )


def rebuilt(turns: DataFrame, prefix: Column, base: Column, most: int) -> DataFrame:
    """(conv_id, depth, x, y, n_chars, n_turns, g): each conversation begun with turns of another one.

    The first ``prefix`` turns (``most`` at most) of conversation ``base`` are followed by the
    conversation's own turns after its first ``prefix``. One row at depth 0 stands for every
    conversation, also one left without turns. ``g`` is the first turn's hash.
    """
    first = F.max(F.when(F.col("j") == prefix, F.col("x")))  # of the conversation's own turns after the prefix
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"), first.alias("first"))
    heads = turns.where(F.col("j") < most)
    head_first = F.max(F.when(F.col("j") == 0, F.col("x")))
    bases = heads.groupBy("conv_id").agg(F.count("*").alias("head"), head_first.alias("head_first"))
    plan = sizes.select("*", prefix.alias("h"), base.alias("base"))
    plan = plan.join(bases.withColumnRenamed("conv_id", "base"), "base", "left")
    plan = plan.withColumn("taken", F.least("h", F.coalesce("head", F.lit(0)))).select(
        "conv_id",
        "h",
        "base",
        "taken",
        (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"),
        F.when(F.col("taken") > 0, F.col("head_first")).otherwise(F.col("first")).alias("g"),
    )
    plan = materialize(plan, "plan")
    heads = heads.select(F.col("conv_id").alias("base"), "j", "x", "y", "n_chars")
    taken = plan.join(heads, "base").where("j < h")
    own = plan.join(turns, "conv_id").where("j >= h").withColumn("j", F.col("j") - F.col("h") + F.col("taken"))
    zero = F.lit(0).cast("long")
    roots = plan.select("conv_id", zero.alias("depth"), *(zero.alias(c) for c in ("x", "y", "n_chars")), "n_turns", "g")
    columns = ["conv_id", (F.col("j") + 1).alias("depth"), "x", "y", "n_chars", "n_turns", "g"]
    return taken.select(columns).unionByName(own.select(columns)).unionByName(roots)


def hundred_prefix(turns: DataFrame) -> DataFrame:
    """Every conversation begun with the first crc32(id) % 6 turns of the one its hundred begins with."""
    h = F.crc32(F.col("conv_id").cast("string")) % 6
    return rebuilt(turns, h, F.col("conv_id") - F.col("conv_id") % 100, 5)


# --- nodes ---------------------------------------------------------------------------


def paths(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Rows of ``rebuilt`` with their node's key (depth, a, b), its parent's (pa, pb)."""
    values = {n: F.xxhash64("depth", F.col(c)) for n, c in (("a", "x"), ("b", "y"))}
    values = {n: F.when(F.col("depth") > 0, v).otherwise(F.lit(0).cast("long")) for n, v in values.items()}
    keyed = turns.withColumns({f"own_{n}": v for n, v in values.items()})
    keyed = _running(
        keyed,
        F.floor(F.col("depth") / stretch).cast("long"),
        [F.col("depth")],
        {n: F.col(f"own_{n}") for n in values},
        F.bit_xor,
    )
    return keyed.select(
        "conv_id",
        *_KEY,
        F.col("a").bitwiseXOR(F.col("own_a")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("own_b")).alias("pb"),
        "n_chars",
        "n_turns",
        "g",
    )


def _nodes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max(F.col("n_turns") > F.col("depth")).alias("goes_on"),
        F.max("n_chars").alias("n_chars"),
        F.max("pa").alias("pa"),
        F.max("pb").alias("pb"),
        F.max("g").alias("g"),  # all members share it, but for the root's
    )


def end_digests(rows: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the nodes that conversations end at.

    Ids are written out in blocks of neighbouring ids, which bounds a group however many end
    at one node; the blocks then pass through one digest a node, in order and one at a time.
    """
    ends = rows.where(F.col("depth") == F.col("n_turns")).select(*_KEY, "conv_id")
    block = F.shiftright("conv_id", _ID_BLOCK)
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = ends.groupBy(*_KEY, block.alias("block")).agg(ids.alias("ids"))
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c) for c in zip(*out, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, [*_KEY, "ends_sha256"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*_KEY, "ids")]
            for depth, a, b, text in zip(*columns, strict=True):
                if key == (depth, a, b):
                    digest.update(b",")
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (depth, a, b), hashlib.sha256()
                digest.update(text.encode())
            if len(out) > 10_000:
                yield batch_of()
        if key is not None:
            out.append((*key, digest.hexdigest()))
            yield batch_of()

    # Within a node blocks are rows of bounded text; only their digest needs their order.
    dealt = blocks.repartition(*_KEY).sortWithinPartitions(*_KEY, "block").select(*_KEY, "ids")
    return dealt.mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


# --- time-forward processing -----------------------------------------------------------


class SpillingQueue:
    """A priority queue of rows of integers, least first by their first ``key`` columns.

    Rows are pushed in blocks. Beyond ``limit`` of them the ones at hand are sorted and go to
    a temporary file as a run, which is read back from its beginning, block by block.
    """

    def __init__(self, width: int, key: int, limit: int = QUEUE_ROWS):
        self.width, self.key, self.limit = width, key, limit
        self.held: list[np.ndarray] = []
        self.size = 0
        self.runs: list[tuple] = []  # (file, rows read ahead)

    def _sorted(self, rows: np.ndarray) -> np.ndarray:
        return rows[np.lexsort(rows[:, : self.key].T[::-1])]

    def push(self, rows: np.ndarray) -> None:
        self.held.append(rows)
        self.size += len(rows)
        if self.size > self.limit:
            run = self._sorted(np.concatenate(self.held))
            file = tempfile.TemporaryFile()
            file.write(run.tobytes())
            file.seek(0)
            self.runs.append((file, run[:0]))
            self.held, self.size = [], 0

    def _ahead(self, file) -> np.ndarray:
        data = file.read(max(1, self.limit // 16) * self.width * 8)
        return np.frombuffer(data, np.int64).reshape(-1, self.width)

    def _through(self, rows: np.ndarray, last: tuple) -> int:
        """How many of sorted rows come up to ``last``."""
        lo, hi = 0, len(rows)
        for column, value in enumerate(last):
            part = rows[lo:hi, column]
            first, after = np.searchsorted(part, value), np.searchsorted(part, value, side="right")
            if first == after or column == len(last) - 1:
                return lo + int(after)
            lo, hi = lo + int(first), lo + int(after)
        return hi

    def pop_through(self, last: tuple) -> np.ndarray:
        """Take out all rows up to ``last``, in order."""
        out = []
        if self.held:
            rows = self._sorted(np.concatenate(self.held))
            n = self._through(rows, last)
            out.append(rows[:n])
            self.held, self.size = [rows[n:]], len(rows) - n
        runs = []
        for file, ahead in self.runs:
            while True:
                if not len(ahead):
                    ahead = self._ahead(file)
                n = self._through(ahead, last)
                out.append(ahead[:n])
                ended, ahead = not len(ahead), ahead[n:]
                if ended or len(ahead):
                    break
            if ended:
                file.close()
            else:
                runs.append((file, ahead))
        self.runs = runs
        return self._sorted(np.concatenate(out)) if out else np.zeros((0, self.width), np.int64)


# A record's place (level is -depth), the parent's key, whether it is a node (1) or only a copy
# of one or a message (0), and its own totals.
_PLACE = ["shard", "level", "a", "b"]
_TOTALS = ["n_children", "n_leaves", "saved"]
_RECORD = [*_PLACE, "pa", "pb", "is_node", *_TOTALS]


def _heads(rows: np.ndarray, width: int) -> np.ndarray:
    """Where rows begin that differ from the one before in their first ``width`` columns."""
    if not len(rows):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], (rows[1:, :width] != rows[:-1, :width]).any(1))))


def _added_up(rows: np.ndarray) -> np.ndarray:
    """One record a place: the parent is a node's or a copy's (a message has the least number), the rest adds up."""
    at = _heads(rows, 4)
    if len(at) == len(rows):
        return rows
    out = rows[at]
    out[:, 4:6] = np.maximum.reduceat(rows[:, 4:6], at)
    out[:, 6:] = np.add.reduceat(rows[:, 6:], at)
    return out


def _receive(part: np.ndarray, sent: np.ndarray) -> None:
    """Add messages (place, totals) to the records of their places; both are sorted."""
    at = _heads(sent, 4)
    sums = np.add.reduceat(sent[:, 4:], at)
    keys = np.concatenate([part[:, 2:4], sent[at, 2:4]])
    number = np.concatenate([np.full(len(part), -1), np.arange(len(at))])
    order = np.lexsort((number, keys[:, 1], keys[:, 0]))  # a place's record comes before its message
    keys, number = keys[order], number[order]
    to = np.flatnonzero(number >= 0)
    if (keys[to] != keys[to - 1]).any() or (number[to - 1] >= 0).any():
        raise RuntimeError("a node has no parent in its shard")
    part[order[to - 1], 7:] += sums[number[to]]


def time_forward(blocks: Iterator[np.ndarray], band: int = BAND, limit: int = QUEUE_ROWS) -> Iterator[np.ndarray]:
    """Records with their subtree's totals, from records sorted by place, deepest level of a shard first.

    Records of one place are added up. A place's totals are its own and what its children
    sent; it sends its leaves and savings on to its parent, and one child if it is a node.
    The top level of a band has its parents in another shard and sends nothing.
    """
    queue = SpillingQueue(7, 4, limit)
    kept = np.zeros((0, len(_RECORD)), np.int64)

    def settle(rows: np.ndarray) -> Iterator[np.ndarray]:
        cuts = [*_heads(rows, 2).tolist(), len(rows)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):  # one level of one shard
            part = rows[lo:hi]
            sent = queue.pop_through(tuple(part[-1, :4].tolist()))
            if len(sent):
                _receive(part, sent)
            yield part
            if (-part[0, 1] - 1) % band:
                up = part[:, [0, 1, 4, 5, 6, 8, 9]]
                up[:, 1] += 1
                queue.push(up)

    for block in blocks:
        rows = _added_up(np.concatenate([kept, block]))
        kept = rows[-1:]  # the next block may go on with this place
        yield from settle(rows[:-1])
    yield from settle(kept)


def _sent_whole_if_few(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcasting if it is small; a larger one is joined by its key."""
    return F.broadcast(df) if df.count() <= FEW_ROWS else df


def _shards(df: DataFrame, hot: DataFrame, shards: int, band: int) -> DataFrame:
    """Add the shard of a row of ``conv_id`` at ``depth`` below the first turn ``g``."""
    salt = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("conv_id"), F.col("salts")))
    place = F.xxhash64("g", F.coalesce(salt, F.lit(-1).cast("long")), F.floor((F.col("depth") - 1) / band))
    return df.join(hot, "g", "left").withColumn("shard", F.pmod(place, F.lit(shards)))


def _records(rows: DataFrame, nodes: DataFrame, shard_rows: int, band: int) -> DataFrame:
    """Nodes, copies of nodes and messages from lower bands, dealt to shards."""
    below = rows.where("depth > 0").select("conv_id", *_KEY, "pa", "pb", "g")
    own = nodes.where("depth > 0").select(
        "conv_id", *_KEY, "pa", "pb", "g", F.when(F.col("goes_on"), 0).otherwise(1).cast("long").alias("n_leaves"), "saved"
    )
    zero, one = (F.lit(v).cast("long") for v in (0, 1))
    first_turns = below.groupBy("g").agg(F.count("*").alias("n"))
    hot = first_turns.where(F.col("n") > shard_rows).select("g", F.ceil(F.col("n") / shard_rows).alias("salts"))
    hot = _sent_whole_if_few(materialize(hot, "hot"))  # one row for so many rows of the table
    shards = max(1, -(-below.count() // shard_rows))
    columns = ["shard", (-F.col("depth")).alias("level"), "a", "b", "pa", "pb", "is_node", *_TOTALS]

    def dealt(df: DataFrame) -> DataFrame:
        return _shards(df, hot, shards, band).select(columns)

    out = dealt(own.withColumns({"is_node": one, "n_children": zero}))
    copies = below.join(hot.select("g"), "g", "left_semi")
    out = out.unionByName(dealt(copies.withColumns({"is_node": zero, **dict.fromkeys(_TOTALS, zero)})))
    # From band to band: per conversation, what it owns at and below a band's top goes to the
    # turn above that top.
    level = F.floor((F.col("depth") - 1) / band)
    tops = below.where((level > 0) & ((F.col("depth") - 1) % band == 0)).withColumn("band", level)
    owned = own.where(level > 0).groupBy("conv_id", level.alias("band"))
    owned = owned.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    own_top = own.where((level > 0) & ((F.col("depth") - 1) % band == 0)).select("conv_id", "depth", one.alias("n_children"))
    lower = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    seeds = tops.join(owned, ["conv_id", "band"], "left").join(own_top, ["conv_id", "depth"], "left")
    nowhere = F.lit(-(1 << 63)).cast("long")
    seeds = seeds.select(
        "conv_id",
        (F.col("depth") - 1).alias("depth"),
        F.col("pa").alias("a"),
        F.col("pb").alias("b"),
        "g",
        nowhere.alias("pa"),
        nowhere.alias("pb"),
        zero.alias("is_node"),
        F.coalesce("n_children", zero).alias("n_children"),
        *(F.coalesce(F.sum(c).over(lower), zero).alias(c) for c in ("n_leaves", "saved")),
    )
    return out.unionByName(dealt(seeds))


def subtree_totals(rows: DataFrame, nodes: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """(depth, a, b, n_children, n_leaves, saved) of every node: within shards, then across their roots."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (np.stack([c.to_numpy() for c in b.columns], axis=1) for b in batches if b.num_rows)
        for part in time_forward(blocks, band):
            columns = [pa.array(-part[:, 1]), *(pa.array(part[:, i].copy()) for i in (2, 3, 7, 8, 9))]
            yield pa.RecordBatch.from_arrays(columns, [*_KEY, *_TOTALS])

    dealt = _records(rows, nodes, shard_rows, band).repartition("shard").sortWithinPartitions(*_PLACE).select(_RECORD)
    found = dealt.mapInArrow(run, ", ".join(f"{c} long" for c in (*_KEY, *_TOTALS)))
    below = materialize(found.groupBy(_KEY).agg(*(F.sum(c).alias(c) for c in _TOTALS)), "totals")
    zero = F.lit(0).cast("long")
    tops = below.where("depth = 1")
    root = tops.agg(
        *(zero.alias(c) for c in _KEY),
        F.count("*").alias("n_children"),
        F.coalesce(F.sum("n_leaves"), F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce(F.sum("saved"), zero).alias("saved"),
    )
    return below.unionByName(root)


def prefix_trie(
    turns: DataFrame, *, shard_rows: int = SHARD_ROWS, band: int = BAND, many_children: int = MANY_CHILDREN
) -> DataFrame:
    """The trie's nodes, from rebuilt conversations as ``rebuilt`` gives them; no conversations, no nodes.

    conv_id is a node's least member and depth its number of turns; together they name it. saved_tokens counts, over
    a node's subtree, the code points of each node's last text once for every member but one.
    """
    rows = materialize(paths(materialize(turns, "rebuilt")), "paths")
    nodes = materialize(
        _nodes(rows).withColumn("saved", (F.col("n_convs") - 1) * F.col("n_chars")), "nodes"
    )
    totals = subtree_totals(rows, nodes, shard_rows, band)
    known = nodes.select(*_KEY, "pa", "pb", "conv_id", "n_convs").join(totals, _KEY).join(end_digests(rows), _KEY, "left")
    known = materialize(known, "trie")
    up = ["depth", "pa", "pb"]
    parents = known.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("pa"),
        F.col("b").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
        "n_children",
    )
    # Parents of very many children are few; a group of their children is never brought together.
    large = F.col("n_children") > many_children
    many, few = (parents.where(c).drop("n_children") for c in (large | (F.col("depth") == 1), ~large & (F.col("depth") > 1)))
    many = _sent_whole_if_few(many)
    below = known.where("depth > 0")
    with_parents = below.join(many, up).unionByName(below.join(many, up, "left_anti").join(few, up))
    roots = known.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return with_parents.unionByName(roots, allowMissingColumns=True).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all ``conversations`` (conv_id, turn, role, text), each begun as its hundred's first one."""
    return prefix_trie(hundred_prefix(materialize(numbered_turns(conversations), "turns")))
