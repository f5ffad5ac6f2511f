"""Exact k-nearest-neighbour search of a query set against a distributed
vector corpus (R4, L2).

The corpus is scanned once, however many queries there are. A task holds the query set as
one matrix a vector width, looks through its Arrow batches with numpy, and keeps the best k
rows of each query over all its batches; it emits those alone, so no query × corpus
pairs are ever materialized or shuffled. A final ``row_number`` per query (planned as a
partial + final ``WindowGroupLimit``) keeps the global top k.

How the queries reach the tasks depends on their size in bytes, which is checked first: up
to ``MAX_BROADCAST_BYTES`` they are broadcast. A larger set is sent by shuffle: the
corpus is dealt into shards, every shard meets the query blocks one after another, sorted
behind its own rows. Both ways give the same rows.

Ranking key is ``(distance rounded HALF_UP to scale places, corpus id)``:
distances equal to the scale are ties, decided by id. The key is computed in
the task (once per distinct raw distance), so the final ranking sees the same keys and the
result is exact — and a group of copies, however large, contributes at most k rows a task.

Vectors that are NULL, empty or hold NULL or non-finite components take no part on either
side; vectors of another width than a query's have no distance to it; a repeated query id
counts once, with its smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

MAX_BROADCAST_QUERIES = 4096  # hits of so many questions are small enough to broadcast
MAX_BROADCAST_BYTES = 64 << 20  # of query vectors
SHARD_ROWS = 65_536  # corpus rows a shard where the queries come by shuffle
BLOCK_ROWS = 4096  # queries a block there
DISTANCE_SCALE = 6


def _matrix(values, normalize: bool) -> np.ndarray:
    m = np.concatenate(values).astype(np.float64).reshape(len(values), -1) if len(values) else np.zeros((0, 0))
    if normalize and m.size:
        n = np.sqrt((m * m).sum(axis=1, keepdims=True))
        m = np.divide(m, n, out=np.zeros_like(m), where=n > 0)
    return m


def _rounded(values: np.ndarray, scale: int) -> np.ndarray:
    """HALF_UP rounding of each value's shortest decimal form (SQL ``round``)."""
    values = np.asarray(values, dtype=np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = values * 10.0**scale
        whole = np.floor(scaled)
        part = scaled - whole
        out = (whole + (part >= 0.5)) / 10.0**scale
        # near a half, or too large for floats to tell, the decimal form itself decides
        unsure = np.flatnonzero(~((values >= 0) & (scaled < 2.0**40) & (np.abs(part - 0.5) > 1e-3)))
    if len(unsure):
        step = Decimal(1).scaleb(-scale)
        uniq, inv = np.unique(values[unsure], return_inverse=True)
        out[unsure] = np.array([float(Decimal(repr(float(v))).quantize(step, rounding=ROUND_HALF_UP)) for v in uniq], dtype=np.float64)[inv]
    return out


QUERY_CHUNK = 256
PAIRS = 1 << 16  # distances recomputed at once


class Nearest:
    """The k best (rounded distance, corpus id) of each query of one width so far.

    Distances to a chunk of queries come from one matrix product
    (``|v|² + |q|² − 2 v·q``); they only locate a candidate band, widened by a
    bound on that formula's rounding error, and the band's distances are then
    recomputed directly as ``Σ (v − q)²``, so results equal the direct method."""

    def __init__(self, ids: list, Q: np.ndarray, k: int, scale: int):
        self.ids, self.Q, self.k, self.scale = ids, Q, k, scale
        self.worst = np.full(len(ids), np.inf)  # distance of the k-th best
        # of each chunk of queries the best pairs so far: place of the query, distance, corpus id
        self.kept: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def look(self, V: np.ndarray, ids: np.ndarray) -> None:
        n, k, slack = len(V), self.k, 10.0 ** (-self.scale)
        if n == 0:
            return
        vv = np.einsum("ij,ij->i", V, V)
        for start in range(0, len(self.Q), QUERY_CHUNK):
            Qc = self.Q[start : start + QUERY_CHUNK]
            qq = np.einsum("ij,ij->i", Qc, Qc)
            approx = V @ (-2.0 * Qc.T)  # less |q|², which is on the other side below
            approx += vv[:, None]
            tol = 1e-9 * (1.0 + float(vv.max()) + float(qq.max()))
            bound = self.worst[start : start + QUERY_CHUNK] - qq
            unfilled = np.flatnonzero(~np.isfinite(bound))
            if n > k and len(unfilled):
                bound[unfilled] = np.partition(approx[:, unfilled], k - 1, axis=0)[k - 1]
            rows, cols = np.nonzero(~(approx > bound + slack + 2.0 * tol))
            for i in range(0, len(rows), PAIRS):
                r, c = rows[i : i + PAIRS], cols[i : i + PAIRS]
                diff = V[r] - Qc[c]
                self._keep(start, c, _rounded(np.einsum("ij,ij->i", diff, diff), self.scale), ids[r])

    def _keep(self, start: int, cols: np.ndarray, dist: np.ndarray, cids: np.ndarray) -> None:
        """Puts pairs beside those kept of the chunk and keeps the k best of each query."""
        if start in self.kept:
            c, d, i = self.kept[start]
            if i.dtype != cids.dtype:
                i, cids = i.astype(object), cids.astype(object)
            cols, dist, cids = np.concatenate([c, cols]), np.concatenate([d, dist]), np.concatenate([i, cids])
        ranked = np.unique(cids, return_inverse=True)[1] if cids.dtype == object else cids
        order = np.lexsort((ranked, dist, cols))
        cols, dist, cids = cols[order], dist[order], cids[order]
        first = np.searchsorted(cols, cols)  # where the query's pairs begin
        place = np.arange(len(cols)) - first
        best = place < self.k
        last = place == self.k - 1
        self.worst[start + cols[last]] = dist[last]
        self.kept[start] = cols[best], dist[best], cids[best]

    def rows(self) -> list[tuple]:
        return [
            (self.ids[start + c], cid, d)
            for start, (cols, dist, cids) in self.kept.items()
            for c, cid, d in zip(cols.tolist(), cids.tolist(), dist.tolist(), strict=True)
        ]


def _by_width(values, ids, normalize: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, ids, matrix) of the vectors of each width."""
    width = np.array([len(v) for v in values])
    ids = np.asarray(ids)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        yield w, ids[at], _matrix([values[i] for i in at.tolist()], normalize)


def usable(vec: str) -> Column:
    """The vector is there, and every component is present and finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & F.forall(vec, fine), F.lit(False))


def unusable_vectors(df: DataFrame, vec: str) -> DataFrame:
    """How many rows ``exact_knn`` leaves out: one row, ``n_rows`` and ``n_unusable``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~usable(vec)).alias("n_unusable"))


def exact_knn(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    corpus_id: str,
    corpus_vec: str,
    query_id: str,
    query_vec: str,
    normalize: bool = False,
    scale: int = DISTANCE_SCALE,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, corpus_id, distance, rank)`` for the k nearest corpus
    vectors of every query by squared L2 distance (of unit vectors when
    ``normalize``, i.e. a cosine ranking). Fewer than k vectors → fewer rows."""
    queries = queries.filter(usable(query_vec)).groupBy(query_id).agg(F.min(query_vec).alias(query_vec))
    corpus = corpus.filter(usable(corpus_vec)).select(corpus_id, corpus_vec)
    out_schema = StructType([queries.schema[query_id], corpus.schema[corpus_id], StructField("distance", DoubleType(), True)])
    size = queries.agg(F.coalesce(F.sum(8 * F.size(query_vec)), F.lit(0)).alias("bytes")).first()["bytes"]  # the check that allows the broadcast
    if size <= max_broadcast_bytes:
        cands = _scan(corpus, queries, k, corpus_id, corpus_vec, query_id, query_vec, normalize, scale, out_schema)
    else:
        cands = _meet(corpus, queries, k, corpus_id, corpus_vec, query_id, query_vec, normalize, scale, out_schema)
    w = Window.partitionBy(query_id).orderBy(F.col("distance"), F.col(corpus_id))
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _scan(corpus, queries, k, corpus_id, corpus_vec, query_id, query_vec, normalize, scale, schema) -> DataFrame:
    """One narrow pass; the whole query set is in every task."""
    rows = queries.select(query_id, query_vec).collect()  # of checked size
    asked = {w: (ids.tolist(), Q) for w, ids, Q in _by_width([r[1] for r in rows], [r[0] for r in rows], normalize)}
    context = corpus.sparkSession.sparkContext
    shipped = context.broadcast(asked)
    if len(rows) > QUERY_CHUNK:
        # the work is queries times rows, not the bytes that files were cut by: every core gets a part
        corpus = corpus.repartition(context.defaultParallelism)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = {w: Nearest(ids, Q, k, scale) for w, (ids, Q) in shipped.value.items()}
        for pdf in batches:
            for w, ids, V in _by_width(pdf[corpus_vec].tolist(), pdf[corpus_id].to_numpy(), normalize):
                if w in found:
                    found[w].look(V, ids)
        for near in found.values():
            if rows := near.rows():
                yield pd.DataFrame(rows, columns=[query_id, corpus_id, "distance"])

    return corpus.mapInPandas(run, schema)


def _meet(corpus, queries, k, corpus_id, corpus_vec, query_id, query_vec, normalize, scale, schema) -> DataFrame:
    """Corpus shards and copies of the query blocks come together by shuffle, the shard's rows first."""
    shards = max(1, -(-corpus.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    c, q = corpus.schema, queries.schema
    own = corpus.select(F.pmod(F.xxhash64(corpus_id), F.lit(shards)).cast("int").alias("shard"), F.lit(-1).alias("block"), F.col(corpus_id).alias("cid"), F.lit(None).cast(q[query_id].dataType).alias("qid"), F.col(corpus_vec).cast("array<double>").alias("vec"))
    block = F.pmod(F.xxhash64(F.lit("block"), query_id), F.lit(blocks)).cast("int")
    copies = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"), F.lit(None).cast(c[corpus_id].dataType).alias("cid"), F.col(query_id).alias("qid"), F.col(query_vec).cast("array<double>").alias("vec"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, mine, asked, at = None, [], [], None

        def answer() -> Iterator[pd.DataFrame]:
            for w, ids, Q in _by_width([v for _, v in asked], [i for i, _ in asked], normalize):
                near = Nearest(ids.tolist(), Q, k, scale)
                for width, cids, V in mine:
                    if width == w:
                        near.look(V, cids)
                if rows := near.rows():
                    yield pd.DataFrame(rows, columns=[query_id, corpus_id, "distance"])

        for pdf in batches:
            for (s, b), part in pdf.groupby(["shard", "block"], sort=True):
                if asked and (s, b) != at:
                    yield from answer()
                    asked = []
                if s != shard:
                    shard, mine = s, []
                if b < 0:
                    mine += list(_by_width(part["vec"].tolist(), part["cid"].to_numpy(), normalize))
                else:
                    asked += list(zip(part["qid"].tolist(), part["vec"].tolist(), strict=True))
                at = (s, b)
        if asked:
            yield from answer()

    met = own.unionByName(copies).repartition("shard").sortWithinPartitions("shard", "block")
    return met.mapInPandas(run, schema)
