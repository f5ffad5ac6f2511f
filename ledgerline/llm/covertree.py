"""Exact top-k inner products by dual-tree search over cover trees.

The data are cut into cells around bounded pivots (a sample of at most
``max_pivots`` vectors), large cells into shards of about ``shard`` rows; every
shard gets a cover tree inside its task. Queries come in blocks, and each block
gets a tree of its own. Query nodes and data nodes are visited in pairs: with
centres q, r and covering radii a, b no inner product below them exceeds
q.r + a|r| + b|q| + ab, and the pair is dropped if that is less than the worst
k-th score among the node's queries. k-th scores start from the pivots (real
rows), so whole cells are passed over before anything is shuffled to them, and
tighten as leaves are scored. Each shard returns at most k rows a query; the final
rank is a window over those.

Ties go to the smaller id. Scores are exact integers.

Defined cases: vectors that are NULL or hold NULL, NaN or an infinity take no
part; rows without an id neither; a repeated id counts once, with its smallest
vector; a shorter vector is padded with zeros; with fewer than k candidates all
are returned; scores beyond 64 bits are returned as the nearest long; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranges, small_batches, sorted_groups, staged

MAX_PIVOTS = 256
SHARD = 1024
QUERY_BLOCK = 1024
LEAF = 16
SPLIT = 0.5  # a child covers this share of its parent's radius


class CoverTree:
    """Nodes as arrays. Centres of siblings are farther apart than the radius
    they had to cover; ``radius`` is the true distance to the farthest point
    below. The points below a node are ``order[lo:hi]``."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.norm = x, np.sqrt((x * x).sum(1))
        self.order = np.zeros(len(x), np.int64)
        centre, radius, lo, hi, child, children = [], [], [], [], [], []

        def node(c: int, far: float, a: int, b: int) -> int:
            for column, value in zip((centre, radius, lo, hi, child, children), (c, far, a, b, 0, 0), strict=True):
                column.append(value)
            return len(centre) - 1

        todo = []
        if len(x):
            distance = self._from(0, np.arange(len(x)))
            todo.append((node(0, float(distance.max()), 0, len(x)), np.arange(len(x)), distance))
        while todo:
            me, points, distance = todo.pop()
            far = radius[me]
            if len(points) <= leaf or far == 0:
                self.order[lo[me] : hi[me]] = points
                continue
            cover, groups = far * SPLIT, []
            c = centre[me]
            while len(points):
                inside = distance <= cover
                groups.append((c, points[inside], distance[inside]))
                points, distance = points[~inside], distance[~inside]
                if len(points):
                    c = int(points[distance.argmax()])
                    distance = self._from(c, points)
            child[me], children[me] = len(centre), len(groups)
            at = lo[me]
            for c, p, d in groups:
                todo.append((node(c, float(d.max()), at, at + len(p)), p, d))
                at += len(p)
        self.centre, self.child, self.children, self.lo, self.hi = (np.array(v, np.int64) for v in (centre, child, children, lo, hi))
        self.radius = np.array(radius) * (1 + 1e-9)

    def _from(self, c: int, points: np.ndarray) -> np.ndarray:
        """Distances from point c."""
        d = self.x[points] - self.x[c]
        return np.sqrt((d * d).sum(1))


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as float64 where that is exact and else as Python integers."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        return q @ x.T
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)
    return whole(q) @ whole(x).T


class Search:
    """k best data rows for each query of a block, continued over several shards if wanted."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int):
        self.tree, self.ids, self.k = CoverTree(vectors), ids, k
        self.worst = floor.copy()  # k-th score known so far, or a lower bound of it
        self.best: list[list[tuple]] = [[] for _ in ids]
        self.scored = 0

    def run(self, data: CoverTree, data_ids: np.ndarray) -> None:
        if len(self.ids) and len(data_ids):
            self._visit(0, np.zeros(1, np.int64), data, data_ids)

    def _alive(self, q: int, nodes: np.ndarray, data: CoverTree) -> np.ndarray:
        """Nodes that may hold a better row for some query below q, most promising first."""
        t = self.tree
        group = t.order[t.lo[q] : t.hi[q]]
        a, c = t.radius[q], t.centre[q]
        r = data.centre[nodes]
        bound = data.x[r] @ t.x[c] + a * data.norm[r] + data.radius[nodes] * (t.norm[c] + a)
        bound += 1e-9 * np.abs(bound) + 1e-6
        keep = bound >= self.worst[group].min()
        return nodes[keep][np.argsort(-bound[keep], kind="stable")]

    def _visit(self, q: int, nodes: np.ndarray, data: CoverTree, data_ids: np.ndarray) -> None:
        t = self.tree
        nodes = self._alive(q, nodes, data)
        while True:  # open data nodes that are wider than the query node
            wide = (data.radius[nodes] > t.radius[q]) & (data.children[nodes] > 0)
            if not wide.any():
                break
            opened = ranges(data.child[nodes[wide]], data.children[nodes[wide]])
            nodes = self._alive(q, np.concatenate([nodes[~wide], opened]), data)
        if t.children[q]:
            for child in range(t.child[q], t.child[q] + t.children[q]):
                self._visit(child, nodes, data, data_ids)
            return
        # a leaf of queries: score the most promising points first, in growing steps
        step = 8
        while len(nodes):
            head, nodes = nodes[:step], nodes[step:]
            self._score(q, data.order[ranges(data.lo[head], data.hi[head] - data.lo[head])], data, data_ids)
            nodes = self._alive(q, nodes, data)
            step *= 4

    def _score(self, q: int, points: np.ndarray, data: CoverTree, data_ids: np.ndarray) -> None:
        t = self.tree
        group = t.order[t.lo[q] : t.hi[q]]
        scores = inner(t.x[group], data.x[points])
        ids = data_ids[points]
        self.scored += scores.size
        for row in np.flatnonzero((scores >= self.worst[group][:, None]).any(1)).tolist():
            i = int(group[row])
            s = scores[row]
            good = np.flatnonzero((s >= self.worst[i]) & (ids != self.ids[i]))
            if not len(good):
                continue
            if len(good) > self.k and s.dtype != object:
                cut = np.partition(s[good], -self.k)[-self.k]
                good = good[s[good] >= cut]
            merged = self.best[i] + [(-int(s[j]), int(ids[j])) for j in good.tolist()]
            self.best[i] = sorted(merged)[: self.k]
            if len(self.best[i]) == self.k:
                self.worst[i] = max(self.worst[i], float(-self.best[i][-1][0]))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Arrow list column as rows padded with zeros to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    n = np.diff(column.offsets.to_numpy())
    if len(n) and (n == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(n), width))
    out[np.repeat(np.arange(len(n)), n), ranges(np.zeros(len(n), np.int64), n)] = flat
    return out


def usable(embedding: Column) -> Column:
    """Not NULL, and every component present and finite."""
    fine = lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != F.lit(float("inf")))
    return embedding.isNotNull() & F.forall(embedding, fine)


def top_k(data: DataFrame, queries: DataFrame, k: int = 5, max_pivots: int = MAX_PIVOTS, shard: int = SHARD, block: int = QUERY_BLOCK) -> DataFrame:
    """data, queries: id (long) and vector (array<double> of whole numbers). A row
    of the same id as the query is no candidate. Returns query_id, rank, id, score."""
    spark = data.sparkSession
    small_batches(spark, 10_000)
    clean = lambda df: df.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).groupBy("id").agg(F.min("vector").alias("vector"))
    data = staged(clean(data), "vectors")
    facts = data.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    queries = staged(clean(queries), "query-vectors")
    asked = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = max(facts["width"] or 0, asked["width"] or 0, 1)
    wanted = max(1, min(max_pivots, facts["n"] // shard))
    chosen = data.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
    pivots = np.zeros((max(1, len(chosen)), width))
    for i, r in enumerate(chosen):
        pivots[i, : len(r["vector"])] = r["vector"]
    pivot_ids = np.array([r["id"] for r in chosen] or [0], np.int64)
    square = (pivots * pivots).sum(1)

    def nearest(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = (square - 2 * (x @ pivots.T)).argmin(1)
        return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))

    def place(batches):
        for b in batches:
            cell, far = nearest(_matrix(b.column("vector"), width))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vector"), pa.array(cell.astype(np.int32)), pa.array(far)], names=["id", "vector", "cell", "far"])

    located = staged(data.mapInArrow(place, "id long, vector array<double>, cell int, far double"), "cells")
    cells = {r["cell"]: r for r in located.groupBy("cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}  # max_pivots rows at most
    radius = np.array([cells[c]["radius"] if c in cells else -np.inf for c in range(len(pivots))])
    salts = np.array([-(-cells[c]["n"] // shard) if c in cells else 0 for c in range(len(pivots))], np.int64)
    blocks = max(1, -(-asked["n"] // block))
    salt_of = F.element_at(F.array(*[F.lit(int(s)) for s in np.maximum(salts, 1)]), F.col("cell") + 1)
    sharded = located.select("id", "vector", "cell", F.pmod(F.xxhash64("id"), salt_of).cast("int").alias("salt"), F.lit(-1).alias("block"), F.lit(float("-inf")).alias("floor"))

    def route(batches):
        """Each query goes to the shards of every cell that may better its k-th score among the pivots."""
        for b in batches:
            x, ids = _matrix(b.column("vector"), width), b.column("id").to_numpy()
            dots = inner(x, pivots).astype(np.float64)
            known = np.where(pivot_ids[None, :] == ids[:, None], -np.inf, dots)
            floor = np.full(len(x), -np.inf)
            if len(chosen) >= k:
                floor = np.partition(known, -k, axis=1)[:, -k]
            bound = dots + np.sqrt((x * x).sum(1))[:, None] * radius * (1 + 1e-9)
            bound += 1e-9 * np.abs(bound) + 1e-6
            row, cell = np.nonzero((bound >= floor[:, None]) & (salts > 0))
            n = salts[cell]
            row, cell, salt = np.repeat(row, n), np.repeat(cell, n), ranges(np.zeros(len(n), np.int64), n)
            own = nearest(x)[0] * blocks // len(pivots)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(take), b.column("vector").take(take), pa.array(cell.astype(np.int32)), pa.array(salt.astype(np.int32)), pa.array(own[row].astype(np.int32)), pa.array(floor[row])],
                names=["id", "vector", "cell", "salt", "block", "floor"],
            )

    asked_rows = queries.mapInArrow(route, "id long, vector array<double>, cell int, salt int, block int, floor double")

    def search(batches):
        """A shard's rows come first, then the query blocks, one at a time."""
        tree, ids = None, None
        for group in sorted_groups(batches, ["cell", "salt", "block"]):
            x, own = _matrix(group.column("vector"), width), group.column("id").to_numpy()
            if group.column("block")[0].as_py() < 0:
                tree, ids = CoverTree(x), own
                continue
            for a in range(0, len(own), block):
                found = Search(own[a : a + block], x[a : a + block], group.column("floor").to_numpy()[a : a + block], k)
                found.run(tree, ids)
                rows = [(int(q), c, -s) for q, best in zip(found.ids, found.best, strict=True) for s, c in best]
                if rows:
                    q, c, s = zip(*rows, strict=True)
                    clipped = [max(-(2**63), min(2**63 - 1, v)) for v in s]
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(clipped, pa.int64())], names=["query_id", "id", "score"])

    met = sharded.unionByName(asked_rows).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "block")
    hits = met.mapInArrow(search, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return hits.select("query_id", rank.alias("rank"), "id", "score").where(F.col("rank") <= k)
