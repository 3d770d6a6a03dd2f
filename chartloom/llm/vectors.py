"""Embedding near-duplicates through robust-pruned graphs on overlapping cluster shards.

Distinct vectors of a label are divided into clusters, and clusters that are too large
again, each vector going to its nearest and next nearest one. In every shard a flat graph
is built by robust pruning, its islands are tied, and a vector's adjacency lists from its
shards are united. Each vector is then searched for from its shards' medoids and from
itself: a greedy beam walk that, once it is in range, expands every neighbour in range.
What cannot be split into small shards is compared in pairs of bounded blocks. Found pairs
are verified by their cosine, and the recall is audited by brute force on a bounded set of
queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.components import connected
from chartloom.llm.tokens import gather
from chartloom.session import materialize, ship_package

COSINE = 0.98
# Vectors a shard should hold; vectors of a graph or a block at most (a block: about);
# the sample a split is fitted on; parts a split makes at most.
SHARD = 1000
MAX_SHARD = 2 * SHARD
FIT_ROWS = 4096
# A vector also goes to the next nearest centre if that is not farther by more than this.
MARGIN = 0.1
FAN_OUT = 64
MAX_LEVELS = 8
# Centres nearer than this are one: a knot of near-equal vectors is cut into blocks.
KNOT = 0.35
DEGREE, POOL, ALPHA, BEAM = 24, 64, 1.2, 16
AUDIT_QUERIES = 1000
# Of the links, and of the queries that have links those with all of them.
MIN_RECALL, MIN_WHOLE = 0.95, 0.9
_SHARDED = "rep long, n long, v array<double>, shard string"


def _unit(v: pd.Series) -> np.ndarray:
    x = np.array(v.tolist(), dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(label, embedding, rep, n): the distinct vectors that can link with others.

    rep is the least vec_id that has the vector, n how many rows do. Left out: null labels,
    and vectors that are null, empty, zero or hold null or non-finite components.
    """
    wide = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists(wide, lambda x: x != 0)
    usable = rows.where(F.col("label").isNotNull() & F.coalesce(good, F.lit(False)))
    return usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))


def _centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most k centres of unit vectors; centres of one knot are taken together."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), c)
    kept: list[int] = []
    for i in range(len(c)):
        if all(np.linalg.norm(c[i] - c[j]) > KNOT for j in kept):
            kept.append(i)
    return c[kept]


def shards(distinct: DataFrame, overlap: int = 2, levels: int = MAX_LEVELS) -> DataFrame:
    """(rep, n, v, shard): each vector, of unit length, in up to ``overlap`` parts of each split.

    A label is one shard at first. A shard of more than SHARD vectors is split around
    centres fitted on at most FIT_ROWS of them, the first by a hash of their id. Its
    vectors go to their nearest centres. Splitting ends when every shard is small, does not
    fall apart (its vectors form one knot), or after ``levels`` levels.
    """

    def norm(batches):
        for rows in batches:
            v = _unit(rows["embedding"])
            yield pd.DataFrame({"rep": rows["rep"], "n": rows["n"], "v": list(v), "shard": rows["label"].astype(str)})

    placed = materialize(
        distinct.select("rep", "n", F.col("embedding").cast("array<double>").alias("embedding"), "label").mapInPandas(
            norm, _SHARDED
        ),
        "shards",
    )
    done = []
    for _ in range(levels):
        sizes = placed.groupBy("shard").count()
        big = materialize(sizes.where(F.col("count") > MAX_SHARD).where(~F.col("shard").endswith("!")), "sizes")
        if big.isEmpty():
            break
        done.append(placed.join(big.select("shard"), "shard", "left_anti").select("rep", "n", "v", "shard"))
        large = placed.join(big, "shard")
        first = Window.partitionBy("shard").orderBy(F.xxhash64("rep"), "rep")
        sample = large.withColumn("_row", F.row_number().over(first)).where(F.col("_row") <= FIT_ROWS)

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            k = min(FAN_OUT, -(-2 * int(rows["count"].iloc[0]) // SHARD))
            x = np.array(rows["v"].tolist())
            c = _centres(x, k)
            if len(c) <= overlap and np.mean(np.ptp(x @ c.T, axis=1) <= MARGIN) > 0.5:
                c = c[:1]  # most vectors would go to every part
            return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "centres": [c.ravel()]})

        centres = materialize(
            sample.select("shard", "count", "v").groupBy("shard").applyInPandas(fit, "shard string, centres array<double>"),
            "centres",
        )

        def assign(batches):
            for rows in batches:
                for shard, own in rows.groupby("shard"):
                    x = np.array(own["v"].tolist())
                    c = own["centres"].iloc[0].reshape(-1, x.shape[1])
                    sim = x @ c.T
                    near = np.argsort(-sim, axis=1, kind="stable")[:, :overlap]
                    sim = np.take_along_axis(sim, near, 1)
                    for j in range(near.shape[1]):
                        use = np.flatnonzero(sim[:, 0] - sim[:, j] <= MARGIN)
                        if not len(use):  # a frame without rows has no lists that Arrow could tell
                            continue
                        # One centre left: a knot, marked as not to be split again.
                        names = [f"{shard}.{i}" for i in near[use, j]] if len(c) > 1 else [f"{shard}!"] * len(use)
                        part = own.iloc[use]
                        yield pd.DataFrame({"rep": part["rep"], "n": part["n"], "v": list(x[use]), "shard": names})

        # A vector may reach one shard by two ways.
        split = large.select("rep", "n", "v", "shard").join(centres, "shard").mapInPandas(assign, _SHARDED)
        placed = materialize(split.dropDuplicates(["rep", "shard"]), "shards")
    for part in done:
        placed = placed.unionByName(part)
    return placed


def robust_prune(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA) -> np.ndarray:
    """Adjacency (n × degree, -1 where shorter) of unit vectors x.

    From a vector's ``pool`` nearest the nearest is kept again and again, and every other
    that is ``alpha`` times nearer to the kept one than to the vector is dropped.
    """
    n = len(x)
    pool = min(pool, n - 1)
    out = np.full((n, degree), -1, np.int64)
    if pool <= 0:
        return out
    for lo in range(0, n, 512):
        own = np.arange(lo, min(lo + 512, n))
        sim = x[own] @ x.T
        sim[np.arange(len(own)), own] = -np.inf
        cand = np.argpartition(-sim, pool - 1, axis=1)[:, :pool]
        near = np.take_along_axis(sim, cand, 1)
        gap = np.sqrt(np.maximum(0.0, 2 - 2 * near))
        alive = np.ones(cand.shape, bool)
        vectors = x[cand]
        for j in range(degree):
            best = np.argmin(np.where(alive, gap, np.inf), axis=1)
            rows = np.flatnonzero(alive[np.arange(len(own)), best])
            if not len(rows):
                break
            star = cand[rows, best[rows]]
            out[own[rows], j] = star
            between = np.einsum("rpd,rd->rp", vectors[rows], x[star])
            covered = alpha * np.sqrt(np.maximum(0.0, 2 - 2 * between)) <= gap[rows]
            alive[rows] &= ~covered
            alive[rows, best[rows]] = False
    return out


def _merge(island: np.ndarray, own: np.ndarray) -> None:
    """Make one island, named by the least, of those that the positions ``own`` are in."""
    names = np.unique(island[own])
    if len(names) > 1:
        island[np.isin(island, names)] = names[0]


def tie_islands(x: np.ndarray, graph: np.ndarray, cosine: float = COSINE) -> list[np.ndarray]:
    """Adjacency lists of a graph (n × degree, -1 where shorter) whose islands are tied to each other.

    A dense group's nearest vectors all lie inside it, so pruning leaves it alone. Every
    vector gets an edge to the nearest one of each other island if that is in range, and
    every island one to the vector nearest to it, until there is one island.
    """
    near = [g[g >= 0] for g in graph]
    island = np.arange(len(x))
    for i, own in enumerate(near):
        _merge(island, np.append(own, i))
    while len(names := np.unique(island)) > 1:
        found = []
        for name in names:
            inside, outside = np.flatnonzero(island == name), np.flatnonzero(island != name)
            sim = x[outside] @ x[inside].T
            best = np.argmax(sim, axis=1)
            sim = sim[np.arange(len(outside)), best]
            use = sim >= cosine
            use[np.argmax(sim)] = True
            found.append(np.stack([outside[use], inside[best[use]]], axis=1))
        for a, b in np.unique(np.concatenate(found), axis=0):
            near[a] = np.append(near[a], b)
            _merge(island, np.array([a, b]))
    return near


def range_search(x: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, cosine: float = COSINE, beam: int = BEAM):
    """Yield (query, found): positions of x within ``cosine`` of each query position, itself left out.

    A beam walk from the medoid and the query itself; after it, every found vector in range
    is expanded until no new one comes into range.
    """
    n = len(x)
    medoid = int(np.argmax(x @ x.mean(0)))
    counts, flat = _both_ways(graph)
    batch = max(1, min(256, (16 << 20) // max(n, 1)))
    for lo in range(0, len(queries), batch):
        q = queries[lo : lo + batch]
        b = len(q)
        seen = np.zeros((b, n), bool)
        expanded = np.zeros((b, n), bool)
        at = np.full((b, beam), -1, np.int64)
        sim = np.full((b, beam), -np.inf)
        at[:, 0], sim[:, 0] = medoid, x[q] @ x[medoid]
        at[:, 1], sim[:, 1] = np.where(q == medoid, -1, q), np.where(q == medoid, -np.inf, 1.0)
        seen[:, medoid] = True
        seen[np.arange(b), q] = True
        hits_q, hits_v = [np.arange(b)], [q]
        start = np.flatnonzero((sim[:, 0] >= cosine) & (q != medoid))
        hits_q.append(start)
        hits_v.append(np.full(len(start), medoid))
        row = np.arange(b)
        while True:
            open_ = (at >= 0) & ~expanded[row[:, None], np.maximum(at, 0)]
            pick = np.argmax(np.where(open_, sim, -np.inf), axis=1)
            live = np.flatnonzero(open_[row, pick])
            if not len(live):
                break
            node = at[live, pick[live]]
            expanded[live, node] = True
            qi, v = _fresh(live, node, counts, flat, seen)
            s = np.einsum("pd,pd->p", x[q[qi]], x[v])
            near = s >= cosine
            hits_q.append(qi[near])
            hits_v.append(v[near])
            # Fresh neighbours enter the beam where they beat what is there.
            order = np.lexsort((-s, qi))
            qi, v, s = qi[order], v[order], s[order]
            slot = np.arange(len(qi)) - np.searchsorted(qi, qi)
            width = int(slot.max(initial=0)) + 1
            new_at = np.full((b, width), -1, np.int64)
            new_sim = np.full((b, width), -np.inf)
            new_at[qi, slot], new_sim[qi, slot] = v, s
            both_at, both_sim = np.hstack([at, new_at]), np.hstack([sim, new_sim])
            top = np.argsort(-both_sim, axis=1, kind="stable")[:, :beam]
            at, sim = np.take_along_axis(both_at, top, 1), np.take_along_axis(both_sim, top, 1)
        qi, v = np.concatenate(hits_q), np.concatenate(hits_v)
        all_q, all_v = [qi], [v]
        while len(qi):
            todo = ~expanded[qi, v]
            qi, v = qi[todo], v[todo]
            expanded[qi, v] = True
            found_q, found_v = [], []
            for cut in range(0, len(qi), 20_000):
                fq, fv = _fresh(qi[cut : cut + 20_000], v[cut : cut + 20_000], counts, flat, seen)
                near = np.einsum("pd,pd->p", x[q[fq]], x[fv]) >= cosine
                found_q.append(fq[near])
                found_v.append(fv[near])
            qi = np.concatenate(found_q) if found_q else np.zeros(0, np.int64)
            v = np.concatenate(found_v) if found_v else np.zeros(0, np.int64)
            all_q.append(qi)
            all_v.append(v)
        qi, v = np.concatenate(all_q), np.concatenate(all_v)
        order = np.argsort(qi, kind="stable")
        qi, v = qi[order], v[order]
        cuts = np.searchsorted(qi, np.arange(b + 1))
        for i in range(b):
            own = v[cuts[i] : cuts[i + 1]]
            yield int(q[i]), own[own != q[i]]


def _both_ways(graph: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours per vector, all of them) with every edge walkable both ways."""
    n = len(graph)
    a = np.repeat(np.arange(n), [len(g) for g in graph])
    b = np.concatenate(graph).astype(np.int64) if n else np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.bincount(pairs // max(n, 1), minlength=n), pairs % max(n, 1)


def _fresh(
    qi: np.ndarray, nodes: np.ndarray, counts: np.ndarray, flat: np.ndarray, seen: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(query, neighbour of its node) pairs not seen yet, each once; they are seen from now on."""
    v, _ = gather(flat, counts, nodes)
    pair = np.unique(np.repeat(qi, counts[nodes]) * seen.shape[1] + v)
    qi, v = np.divmod(pair, seen.shape[1])
    new = ~seen[qi, v]
    qi, v = qi[new], v[new]
    seen[qi, v] = True
    return qi, v


def _counted_before(rows: pd.DataFrame) -> np.ndarray:
    """Rows × names of shards before this one: whether the vector is in the shard, too."""
    names: dict[str, int] = {}
    shard = rows["shard"].iloc[0]
    member = [[names.setdefault(s, len(names)) for s in own if s < shard] for own in rows["shards"]]
    out = np.zeros((len(rows), max(1, len(names))), np.float32)
    for i, own in enumerate(member):
        out[i, own] = 1
    return out


def links(placed: DataFrame, cosine: float = COSINE, beam: int = BEAM, *, limit: int | None = None) -> DataFrame:
    """(rep, n_links, least): verified links of a vector to other vectors' rows, and a vector it is tied to.

    A pair is counted in the first of the shards that both are in; a vector has a row per
    task that found links of it, tied to the least vector that links lead to there.
    ``placed`` is written once by ``shards``. A shard of up to ``limit`` vectors (MAX_SHARD)
    is searched by its graph. A larger one is cut into blocks of about MAX_SHARD, and every
    two blocks are compared in a task of their own.
    """
    limit = MAX_SHARD if limit is None else limit
    sizes = materialize(
        placed.groupBy("shard").count().select("shard", F.ceil(F.col("count") / MAX_SHARD).alias("blocks"), "count"), "sizes"
    )
    knots = sizes.where(F.col("count") > limit).select("shard", "blocks")
    small = placed.join(knots, "shard", "left_anti").select("rep", "n", "v", "shard")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        x, rep = np.array(rows["v"].tolist()), rows["rep"].to_numpy()
        graph = tie_islands(x, robust_prune(x), cosine)
        return pd.DataFrame({"rep": rep, "near": [rep[g] for g in graph]})

    # A list has DEGREE entries and one for some islands, and a vector is in a few shards: the union is short.
    near = small.groupBy("shard").applyInPandas(build, "rep long, near array<long>")
    joined = near.groupBy("rep").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")
    )
    listed = placed.groupBy("rep").agg(F.sort_array(F.collect_set("shard")).alias("shards"))
    full = small.join(joined, "rep").join(listed, "rep")

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        x, rep, n = np.array(rows["v"].tolist()), rows["rep"].to_numpy(), rows["n"].to_numpy()
        before = _counted_before(rows) > 0
        graph = []
        for own in rows["near"]:
            at = np.searchsorted(rep, own)
            at[at == len(rep)] = 0
            graph.append(at[rep[at] == own])
        out_n, island = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for i, found in range_search(x, graph, np.arange(len(rep)), cosine, beam):
            if len(found):
                _merge(island, np.append(found, i))
                counted = ~(before[found] & before[i]).any(1)
                out_n[i] = n[found[counted]].sum()
        return pd.DataFrame({"rep": rep, "n_links": out_n, "least": rep[island]})

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        x, rep, n = np.array(rows["v"].tolist()), rows["rep"].to_numpy(), rows["n"].to_numpy()
        before = _counted_before(rows)
        one, other = (np.flatnonzero((rows["block"] == rows[c]).to_numpy()) for c in ("low", "high"))
        out_n, island = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for lo in range(0, len(one), 512):
            own = one[lo : lo + 512]
            found = (x[own] @ x[other].T >= cosine) & (own[:, None] != other)
            counted = found & (before[own] @ before[other].T == 0)
            out_n[own] += counted @ n[other]
            if rows["low"].iloc[0] != rows["high"].iloc[0]:  # one block with itself has each pair twice
                out_n[other] += n[own] @ counted
            for i, row in zip(own, found, strict=True):
                if row.any():
                    _merge(island, np.append(other[row], i))
        return pd.DataFrame({"rep": rep, "n_links": out_n, "least": rep[island]})

    block = F.pmod(F.xxhash64(F.lit("block"), "rep"), "blocks").cast("int")
    dealt = (
        placed.join(knots, "shard")
        .join(listed, "rep")
        .select("rep", "n", "v", "shard", "shards", block.alias("block"), "blocks")
        .withColumn("with", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .select(
            "rep", "n", "v", "shard", "shards", "block",
            F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        )
    )
    result = "rep long, n_links long, least long"
    searched = full.select("rep", "n", "v", "shard", "shards", "near").groupBy("shard").applyInPandas(search, result)
    compared = dealt.groupBy("shard", "low", "high").applyInPandas(compare, result)
    return searched.unionByName(compared).where("n_links > 0 or least <> rep")


def audit(distinct: DataFrame, found: DataFrame, cosine: float = COSINE, queries: int = AUDIT_QUERIES) -> tuple[float, float]:
    """(share of links found, share of queries with all links) of a bounded set of queries, by brute force against all rows.

    The second is taken of the queries that have links.
    """
    unit = distinct.select("rep", "n", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    chosen = unit.orderBy(F.xxhash64("rep"), "rep").limit(queries).toPandas()
    if chosen.empty:
        return 1.0, 1.0
    q, label, ids = _unit(chosen["embedding"]), chosen["label"].to_numpy(), chosen["rep"].to_numpy()

    def count(batches):
        total = np.zeros(len(ids), np.int64)
        for rows in batches:
            x = _unit(rows["embedding"])
            near = (q @ x.T >= cosine) & (label[:, None] == rows["label"].to_numpy()[None]) & (ids[:, None] != rows["rep"].to_numpy()[None])
            total += near @ rows["n"].to_numpy()
        yield pd.DataFrame({"rep": ids, "n_true": total})

    true = unit.mapInPandas(count, "rep long, n_true long").groupBy("rep").agg(F.sum("n_true").alias("n_true"))
    per = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    row = (
        true.join(per, "rep", "left")
        .where("n_true > 0")
        .withColumn("n_found", F.least("n_true", F.coalesce("n_links", F.lit(0))))
        .agg(F.sum("n_true"), F.sum("n_found"), F.avg((F.col("n_found") == F.col("n_true")).cast("double")))
        .first()
    )
    return (row[1] / row[0], row[2]) if row[0] else (1.0, 1.0)


def near_duplicates(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Rows with one vector and label count as linked with each other. Vectors that cannot
    link stand alone. If the audit finds too few of the links, or too many queries without
    all of theirs, shards overlap more and the walk is wider, twice at most; after that
    every label is compared block by block. Repeated rows stay.
    """
    ship_package(rows.sparkSession)
    distinct = materialize(distinct_vectors(rows), "vectors")
    for overlap, beam in ((2, BEAM), (3, 2 * BEAM), (5, 4 * BEAM)):
        found = materialize(links(shards(distinct, overlap), cosine, beam), "links")
        recall, whole = audit(distinct, found, cosine)
        if recall >= MIN_RECALL and whole >= MIN_WHOLE:
            break
    else:
        found = materialize(links(shards(distinct, levels=0), cosine, limit=0), "links")
    groups = connected(found.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("n_links").alias("near"))
    known = (
        distinct.join(counts, "rep", "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("label").alias("_label"),
            F.col("embedding").alias("_embedding"),
            (F.coalesce("near", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    own = rows.select("vec_id", "embedding", "label")
    joined = own.join(known, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
