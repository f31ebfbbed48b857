"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Largest inner product is turned into smallest distance by one more coordinate, sqrt(M - |x|^2) with M
the largest squared norm; queries get length sqrt(M) and 0 there. Trees are fitted on a bounded sample:
a node splits along the difference of two random members, at the median of their projections. Every
vector is then routed to its leaf in every tree. A query walks all trees through one priority queue,
nearest margins first, until the next margin exceeds its bound; all vectors of the opened leaves are
compared exactly in double precision.

The bound is ``factor * radius``. The radius is how far the query's ``k``-th neighbour should be, read off
the sample and carried over to the size of the table by the sample's intrinsic dimension; the factor is the
share of the radius within which sample points find ``REACH`` of their neighbours. So structured
data open few leaves, data without structure as many as they need, and no share is fixed.

Equal vectors are indexed and asked once, with their smallest ids; a query can need no more of them than
it returns. Every vector lies in one block, a stretch of the first tree's leaves that is split where it is
crowded, and carries its leaf in each tree. A query goes to the blocks that hold vectors of its opened
leaves and meets every vector there at most once; one that opens more than ``FEW_LEAVES`` is sent by the nodes
``COARSE`` levels below the roots instead, so what is sent per query is bounded. Queries of a block are dealt
in turn, so no task grows with the table. Recall is measured against brute force in the tests.

Defined cases: rows with a null id or with a vector that is null, empty, zero, of another length
than most, or that holds null or non-finite components take no part. Rows that repeat an id and
vector count once; an id with several vectors is a query and a candidate with each of them. Fewer candidates than asked for give them all. Empty tables give empty results.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrill.llm.common import write_once

TREES = 10
LEAF = 100
SAMPLE = 32_768
REACH = 0.95
PROBES = 256
BLOCK = 16_384
QUERY_BLOCK = 2048
FEW_LEAVES = 256
COARSE = 4


def _grow(sample: np.ndarray, depth: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Normals and thresholds of a complete tree's inner nodes, the children of node v at 2v+1 and 2v+2."""
    nodes = (1 << depth) - 1
    normal, threshold = np.zeros((nodes, sample.shape[1])), np.zeros(nodes)
    members: list = [None] * (2 * nodes + 1)
    members[0] = np.arange(len(sample))
    for v in range(nodes):
        own = members[v]
        direction = np.zeros(sample.shape[1])
        if len(own) > 1:
            a, b = rng.choice(own, 2, replace=False)
            direction = sample[a] - sample[b]
        if not direction.any():
            direction = rng.standard_normal(sample.shape[1])
        normal[v] = direction / np.linalg.norm(direction)
        along = sample[own] @ normal[v]
        threshold[v] = np.median(along) if len(own) else 0.0
        members[2 * v + 1], members[2 * v + 2] = own[along < threshold[v]], own[along >= threshold[v]]
    return normal, threshold


def grow_forest(sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 7) -> list:
    rng = np.random.default_rng(seed)
    return [_grow(sample, depth, rng) for _ in range(trees)]


def leaves_of(x: np.ndarray, tree: tuple, depth: int) -> np.ndarray:
    """Leaf number of each row."""
    at = np.zeros(len(x), np.int64)
    for _ in range(depth):
        at = 2 * at + 1 + (np.einsum("ij,ij->i", x, tree[0][at]) >= tree[1][at])
    return at - ((1 << depth) - 1)


def open_leaves(q: np.ndarray, forest: list, depth: int, bound: float, sizes: np.ndarray, least: int) -> list[int]:
    """The leaves a query opens, by best margin over all trees, as tree * 2^depth + leaf.

    It stops beyond the bound, but not before the opened leaves of some tree hold ``least`` vectors
    (``sizes``: vectors of every leaf).
    """
    inner, width = (1 << depth) - 1, 1 << depth
    margin = [normal @ q - threshold for normal, threshold in forest]
    queue = [(-np.inf, t, 0) for t in range(len(forest))]
    held = [0] * len(forest)
    out = []
    while queue:
        worst, t, v = heapq.heappop(queue)
        if worst > bound and max(held) >= least:
            break
        if v >= inner:
            out.append(t * width + v - inner)
            held[t] += int(sizes[out[-1]])
            continue
        m = float(margin[t][v])
        heapq.heappush(queue, (max(worst, -m), t, 2 * v + 2))
        heapq.heappush(queue, (max(worst, m), t, 2 * v + 1))
    return out


def needed_margin(q: np.ndarray, tree: tuple, leaf: np.ndarray, depth: int) -> np.ndarray:
    """The margin up to which a query has to go in a tree to open each of the given leaves."""
    margin = tree[0] @ q - tree[1]
    at, worst = leaf + (1 << depth) - 1, np.full(len(leaf), -np.inf)
    for _ in range(depth):
        up = (at - 1) // 2
        worst = np.maximum(worst, np.where(at % 2 == 0, -margin[up], margin[up]))
        at = up
    return worst


class Reach:
    """How far queries have to go, learned from a sample of the indexed vectors."""

    def __init__(self, points: np.ndarray, total: int, top: float, forest: list, depth: int, k: int,
                 reach: float = REACH, probes: int = PROBES):
        self.points, self.top = points, top
        expected = k * len(points) / total
        self.rank, self.factor, self.shrink = max(1, int(np.ceil(expected))), np.inf, 1.0
        near = min(k, len(points) - 1)
        if near < 2:
            return  # nothing to learn from: all leaves are opened
        lift = lifted(points, top)
        leaf = [leaves_of(lift, tree, depth) for tree in forest]
        ratios, spread = [], []
        for i in range(0, len(points), max(1, len(points) // probes)):
            q = self.asked(points[i:i + 1])
            far = self.distances(q)[0]
            far[i] = np.inf
            best = np.argpartition(far, near - 1)[:near]
            radius = far[best].max()
            margins = [needed_margin(np.append(q[0], 0.0), tree, at[best], depth) for tree, at in zip(forest, leaf)]
            if radius > 0:
                ratios.append(np.maximum(0.0, np.min(margins, axis=0)) / radius)
                spread.append(np.log(radius / np.maximum(far[best], 1e-9 * radius)).sum() / (near - 1))
        if ratios:
            self.factor = float(np.quantile(np.concatenate(ratios), reach))
            self.shrink = min(1.0, expected) ** float(np.mean(spread))

    def asked(self, x: np.ndarray) -> np.ndarray:
        """Queries with the length of the longest vector; their length does not change what is nearest."""
        return x * (np.sqrt(self.top) / np.linalg.norm(x, axis=1, keepdims=True))

    def distances(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 * self.top - 2 * (q @ self.points.T)))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query the margin beyond which no leaf is opened; the query itself may be in the sample."""
        if not np.isfinite(self.factor):
            return np.full(len(q), np.inf)
        at = min(self.rank, len(self.points) - 1)
        return self.factor * self.shrink * np.partition(self.distances(q), at, axis=1)[:, at]


def signposts(leaves: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves, and the coarse nodes above them as negative numbers."""
    return leaves, -1 - (leaves >> max(0, depth - COARSE))


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(0.0, top - (x * x).sum(axis=1, keepdims=True)))])


def stretches(sizes: np.ndarray, block: int) -> list[tuple[int, int, int]]:
    """(leaf, first block, blocks) for the leaves of one tree: neighbours share a block, a crowded leaf has several."""
    out, block_no, filled = [], -1, block
    for leaf, n in enumerate(sizes.tolist()):
        if filled + n > block:
            block_no, filled = block_no + 1, 0
        blocks = max(1, -(-n // block))
        out.append((leaf, block_no, blocks))
        block_no, filled = block_no + blocks - 1, block if blocks > 1 else filled + n
    return out


def _usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == usual["n"]) if usual else rows.where("false")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, leaf: int = LEAF, reach: float = REACH, sample: int = SAMPLE, block: int = BLOCK,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best found for every row where ``is_query`` (of its id) holds."""
    rows = _usable(vectors, vec_id, vector).dropDuplicates()
    # Zeros of either sign are one value; equal vectors get equal hashes.
    plain = F.transform("v", lambda x: x + 0.0)
    rows = write_once(rows.select("id", plain.alias("v"), F.xxhash64(plain).alias("h1"),
                                  F.xxhash64(F.lit(5), plain).alias("h2")), "vectors")
    same = ["h1", "h2"]
    first = Window.partitionBy(*same).orderBy("id")
    members = write_once(rows.select("id", *same).withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
                         .drop("n"), "members")
    classes = rows.groupBy(*same).agg(F.min_by(F.struct("id", "v"), "id").alias("a"))
    reps = write_once(classes.select(F.col("a.id").alias("rep"), *same, F.col("a.v").alias("v")), "distinct-vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    size = reps.agg(F.count("*").alias("n"), F.max(norm).alias("m")).first()
    if not size["n"]:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total, top = size["n"], size["m"]
    share = min(1.0, 0.9 * sample / total)
    fitted = reps.where(F.pmod(F.xxhash64("h1"), F.lit(1 << 32)) < share * float(1 << 32)).limit(sample)
    points = np.array([r["v"] for r in fitted.select("v").collect()]).reshape(-1, len(reps.first()["v"]))
    depth = max(0, min(int(np.ceil(np.log2(max(1, total / leaf)))), int(np.log2(max(1, len(points) / 8)))))
    forest = grow_forest(lifted(points, top), depth, trees)
    far = Reach(points, total, top, forest, depth, k, reach)

    def grid(frame: pd.DataFrame) -> np.ndarray:
        return np.vstack(frame["v"].to_numpy())

    def index(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                x = lifted(grid(part), top)
                at = [t * (1 << depth) + leaves_of(x, tree, depth) for t, tree in enumerate(forest)]
                at = np.stack(at, axis=1).astype(np.int32)
                yield part.assign(leaves=list(at), signs=list(np.hstack(signposts(at, depth))))

    indexed = write_once(reps.mapInPandas(index, "rep long, h1 long, h2 long, v array<double>, leaves array<int>, "
                                                 "signs array<int>"), "indexed")
    # At most trees * sample / 8 leaves, whatever the size of the table.
    sizes = np.zeros(trees << depth, np.int64)
    for r in indexed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    layout = vectors.sparkSession.createDataFrame(stretches(sizes[:1 << depth], block), "first_leaf int, first_block int, blocks int")
    placed = indexed.withColumn("first_leaf", F.col("leaves")[0]).join(F.broadcast(layout), "first_leaf")
    placed = placed.withColumn("block", (F.col("first_block") + F.pmod(F.xxhash64("h1"), "blocks")).cast("int"))
    held = placed.select("block", F.explode("signs").alias("sign")).distinct()
    placed = placed.select("rep", *same, "v", "leaves", "block")

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for i in range(0, len(part), 256):
                some = part.iloc[i:i + 256]
                q = far.asked(grid(some))
                opened = [open_leaves(np.append(x, 0.0), forest, depth, bound, sizes, k + 1)
                          for x, bound in zip(q, far.bounds(q))]
                signs = [np.unique(signposts(np.array(o), depth)[len(o) > FEW_LEAVES]) for o in opened]
                yield some.assign(opened=opened, signs=signs)

    asked = rows.where(is_query(F.col("id")) if callable(is_query) else is_query).select("id", *same)
    queries = reps.drop("rep").join(asked.select(*same).distinct(), same)
    queries = write_once(queries.mapInPandas(ask, "h1 long, h2 long, v array<double>, opened array<int>, signs array<int>"),
                         "queries")
    routes = write_once(queries.select(*same, F.explode("signs").alias("sign")).join(held, "sign")
                        .select(*same, "block").distinct(), "routes")
    loads = write_once(routes.groupBy("block").agg(F.ceil(F.count("*") / F.lit(query_block)).cast("int").alias("turns")), "loads")
    coming = (routes.join(queries.drop("signs"), same).join(loads, "block")
              .withColumn("turn", F.pmod(F.xxhash64(*same), "turns").cast("int")).drop("turns"))
    waiting = placed.join(loads, "block").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")

    def rerank(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(asking):
            own = own.sort_values("rep")
            x, leaves = grid(own), np.vstack(own["leaves"].to_numpy())
            for i in range(0, len(asking), 256):
                part = asking.iloc[i:i + 256]
                near = grid(part) @ x.T
                for j, opened in enumerate(part["opened"]):
                    wanted = np.zeros(len(sizes), bool)
                    wanted[opened] = True
                    near[j, ~wanted[leaves].any(axis=1)] = -np.inf
                # All that reach the last wanted score, then by score and id, the wanted number of each query.
                last = max(0, near.shape[1] - k - 1)
                least = np.partition(near, last, axis=1)[:, last, None]
                query, at = np.nonzero((near >= least) & np.isfinite(near))
                value = near[query, at]
                best = np.lexsort((at, -value, query))
                query, at, value = query[best], at[best], value[best]
                good = np.arange(len(query)) - np.searchsorted(query, query) <= k
                query, at = query[good], at[good]
                out.append(pd.DataFrame({"q1": part["h1"].to_numpy()[query], "q2": part["h2"].to_numpy()[query],
                                         "rep": own["rep"].to_numpy()[at], "h1": own["h1"].to_numpy()[at],
                                         "h2": own["h2"].to_numpy()[at], "score": value[good]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("q1", "q2", "rep", "h1", "h2", "score")})

    place = ["block", "turn"]
    found = (waiting.groupBy(*place).cogroup(coming.groupBy(*place))
             .applyInPandas(rerank, "q1 long, q2 long, rep long, h1 long, h2 long, score double"))
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "rep", *same)
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n", "rep")
    asking = asked.select(F.col("id").alias("query_id"), F.col("h1").alias("q1"), F.col("h2").alias("q2"))
    all_ids = found.join(members, same).join(asking, ["q1", "q2"]).where("id <> query_id")
    all_ids = all_ids.groupBy("query_id", "id", *same).agg(F.max("score").alias("score"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (all_ids.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))
