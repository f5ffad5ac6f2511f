"""Hard negatives by segment summary filtering.

For each anchor the best rows of its own label are its positives; for each positive the
best rows of other labels are wanted whose score lies between two shares of the
positive's score. Scores are integer inner products.

Every vector's segments are summed up by mean and deviation. For segments x, y of L
components with means p, q and deviations (lengths of what is left) a, b, the inner product
lies within L p q - a b and L p q + a b; summed over the segments this bounds a pair's
score from both sides. Bounds are worked out for a few wide segments first; pairs that
cannot reach the score to beat, or whose bounds lie outside every window, go; the
pairs left are looked at again in finer segments, and only what outlives the finest
level is scored exactly.

Rows are dealt into shards by a hash of the id; every shard gets the anchors in blocks
once for the positives and once, with the score windows these give, for the negatives. A
shard returns at most the wanted number of rows for each anchor, or anchor and
positive; the final rank is a window over those. Shards grow with the table, so the
copies of anchors stay a small part of the pairs compared.

Defined cases: rows whose id, label or vector is NULL, or with a NULL or non-finite
component, take no part; a repeated id counts once, with its smallest label and
vector; a shorter vector is padded with zeros; an anchor without another row of its label has
no positives and no rows; fewer rows than wanted are all returned; a negative
positive score has no window; scores beyond 64 bits are returned as the nearest long; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, sorted_groups, staged
from .covertree import _matrix, inner

LEVELS = (4, 16, 32)  # segments of a vector, from coarse to fine
SHARD_ROWS = (2048, 65_536)  # rows of a shard: least and most
SHARD_BYTES = 32 << 20
SHARDS = 64  # shards of a table that is small for the least and large for the most
ANCHOR_BLOCK = 256
ROWS_AT_ONCE = 4096
FIRST = 32  # rows scored for each anchor before the bounds are used
LONG = 2**63 - 1


class Summary:
    """Vectors with the means and deviations of their segments at each level. Means
    carry the root of the segment's length, so products need no factor."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        width = x.shape[1]
        self.levels = []
        for segments in LEVELS:
            length = -(-max(1, width) // segments)
            padded = np.zeros((n, segments * length))
            padded[:, :width] = x
            parts = padded.reshape(n, segments, length)
            with np.errstate(over="ignore", invalid="ignore"):
                mean = parts.mean(2)
                rest = parts - mean[:, :, None]
                self.levels.append((mean * np.sqrt(length), np.sqrt((rest * rest).sum(2))))

    def __getitem__(self, rows) -> "Summary":
        out = object.__new__(Summary)
        out.x, out.levels = self.x[rows], [(m[rows], d[rows]) for m, d in self.levels]
        return out


def dense_bounds(a: Summary, b: Summary, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Middle and radius of the score bounds of all pairs, rounding included."""
    (ma, da), (mb, db) = a.levels[level], b.levels[level]
    with np.errstate(over="ignore", invalid="ignore"):
        middle, radius = ma @ mb.T, da @ db.T
        size = np.abs(ma) @ np.abs(mb).T
        return middle, radius * (1 + 1e-9) + 1e-9 * size + 1e-6


def pair_bounds(a: Summary, b: Summary, level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for listed pairs."""
    (ma, da), (mb, db) = a.levels[level], b.levels[level]
    with np.errstate(over="ignore", invalid="ignore"):
        products = ma[i] * mb[j]
        radius = np.einsum("ij,ij->i", da[i], db[j])
        return products.sum(1), radius * (1 + 1e-9) + 1e-9 * np.abs(products).sum(1) + 1e-6


class Wanted:
    """The best rows so far of each (anchor, window); a window is a range of scores."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        """low, high: anchors x windows; an empty window has low > high."""
        self.low, self.high, self.k = low, high, k
        self.floor = np.nextafter(low.astype(np.float64), -np.inf)  # rounded down: whole scores beyond 2^53 are compared as such
        self.best: list[list[list[tuple]]] = [[[] for _ in row] for row in low]

    def open(self, anchor: np.ndarray | slice, middle: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Pairs whose bounds meet some window at or above its floor; anchor indexes middle's first axis."""
        floor, high = self.floor[anchor], self.high[anchor]
        out = np.zeros(middle.shape, bool)
        wide = (slice(None),) + (None,) * (middle.ndim - 1)
        for w in range(floor.shape[1]):  # a bound that is no number rules nothing out
            out |= ~(middle + radius < floor[:, w][wide]) & ~(middle - radius > high[:, w][wide])
        return out & (self.low[anchor] <= high).any(1)[wide]

    def add(self, anchor: int, scores, ids: np.ndarray) -> None:
        """Exact scores of rows for one anchor."""
        for w in range(self.low.shape[1]):
            good = np.flatnonzero((scores >= self.floor[anchor, w]) & (scores >= self.low[anchor, w]) & (scores <= self.high[anchor, w]))
            if not len(good):
                continue
            if len(good) > self.k and scores.dtype != object:
                good = good[scores[good] >= np.partition(scores[good], -self.k)[-self.k]]
            best = self.best[anchor][w] + [(-int(scores[j]), int(ids[j])) for j in good.tolist()]
            self.best[anchor][w] = best = sorted(best)[: self.k]
            if len(best) == self.k:
                self.floor[anchor, w] = max(self.floor[anchor, w], np.nextafter(float(-best[-1][0]), -np.inf))


def scan(anchors: Summary, rows: Summary, ids: np.ndarray, allowed: np.ndarray, wanted: Wanted) -> int:
    """Looks through rows (of which ``allowed``, anchors x rows, may be taken) for every anchor; returns how many pairs were scored."""
    middle, radius = dense_bounds(anchors, rows, 0)
    alive = allowed & wanted.open(slice(None), middle, radius)
    scored = 0

    def score(i: int, at: np.ndarray) -> None:
        nonlocal scored
        scored += len(at)
        wanted.add(i, inner(anchors.x[i : i + 1], rows.x[at])[0], ids[at])

    # the rows that look best below the top of a window give first scores to beat
    for i in np.flatnonzero(alive.any(1)).tolist():
        first: list[np.ndarray] = []
        for w in range(wanted.low.shape[1]):
            at = np.flatnonzero(alive[i] & ~(middle[i] > wanted.high[i, w]))
            if len(at) > FIRST:
                at = at[np.argpartition(-middle[i, at], FIRST)[:FIRST]]
            first.append(at)
        at = np.unique(np.concatenate(first))
        if len(at):
            score(i, at)
            alive[i, at] = False
    alive &= wanted.open(slice(None), middle, radius)
    for level in range(1, len(LEVELS)):
        if alive.mean() > 0.1:
            alive &= wanted.open(slice(None), *dense_bounds(anchors, rows, level))
        else:
            i, j = np.nonzero(alive)
            for lo in range(0, len(i), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                keep = wanted.open(i[part], *pair_bounds(anchors, rows, level, i[part], j[part]))
                alive[i[part], j[part]] = keep
    for i in np.flatnonzero(alive.any(1)).tolist():
        score(i, np.flatnonzero(alive[i]))
    return scored


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """rows: id, label (longs), vector (array<double> of whole numbers); is_anchor: a condition on them.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score, where
    low * positive_score <= 100 * negative_score <= high * positive_score."""
    spark = rows.sparkSession
    small_batches(spark, 10_000)
    clean = rows.select("id", "label", "vector", is_anchor.alias("asks")).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    clean = clean.groupBy("id").agg(F.min(F.struct("label", "vector", "asks")).alias("row")).select("id", "row.label", "row.vector", "row.asks")
    clean = staged(clean, "labelled-vectors")
    facts = clean.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.count_if("asks").alias("asking")).first()
    width = max(1, facts["width"] or 1)
    most = min(SHARD_ROWS[1], max(SHARD_ROWS[0], facts["n"] // SHARDS), max(1, SHARD_BYTES // (8 * width)))
    shards = max(1, -(-facts["n"] // most))
    blocks = max(1, -(-facts["asking"] // ANCHOR_BLOCK))
    dealt = clean.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(-1).alias("block"), "id", "label", "vector")

    def meet(anchors: DataFrame, carried: str, reply: str, run):
        """Every shard's rows, then the anchor blocks, one at a time, to ``run``."""
        asked = anchors.select(
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)).cast("int").alias("block"), "id", "label", "vector", carried
        )
        met = dealt.withColumn(carried, F.lit(None).cast(anchors.schema[carried].dataType)).unionByName(asked)

        def task(batches):
            parts: list[tuple[Summary, np.ndarray, np.ndarray]] = []
            shard = None
            for group in sorted_groups(batches, ["shard", "block"]):
                ids, label = (group.column(c).to_numpy() for c in ("id", "label"))
                if group.column("block")[0].as_py() < 0:
                    shard, x = group.column("shard")[0].as_py(), _matrix(group.column("vector"), width)
                    order = np.lexsort((ids, label))
                    parts = [(Summary(x[p]), ids[p], label[p]) for p in (order[a : a + ROWS_AT_ONCE] for a in range(0, len(x), ROWS_AT_ONCE))]
                elif group.column("shard")[0].as_py() == shard:
                    for a in range(0, len(ids), ANCHOR_BLOCK):
                        block = group.slice(a, ANCHOR_BLOCK)
                        found = run(Summary(_matrix(block.column("vector"), width)), ids[a : a + ANCHOR_BLOCK], label[a : a + ANCHOR_BLOCK], block.column(carried), parts)
                        if found.num_rows:
                            yield found

        return met.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(task, reply)

    clip = lambda s: max(-LONG - 1, min(LONG, s))

    def same_label(anchors, ids, label, _, parts):
        out = []
        for one in np.unique(label):
            mine = np.flatnonzero(label == one)
            everything = np.full((len(mine), 1), np.inf)
            wanted, asking = Wanted(-everything, everything, positives), anchors[mine]
            for rows_, row_ids, row_label in parts:
                at = slice(*np.searchsorted(row_label, [one, one + 1]))  # rows come by label
                if at.stop > at.start:
                    scan(asking, rows_[at], row_ids[at], ids[mine][:, None] != row_ids[at], wanted)
            out += [(int(a), c, clip(-s)) for a, best in zip(ids[mine], wanted.best, strict=True) for s, c in best[0]]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["anchor_id", "id", "score"])

    anchors = clean.where("asks")
    near = meet(anchors.withColumn("windows", F.lit(0)), "windows", "anchor_id long, id long, score long", same_label)
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    near = near.withColumn("rank", rank).where(F.col("rank") <= positives)
    windows = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("windows"))  # at most ``positives`` of each
    known = staged(anchors.join(windows, anchors["id"] == windows["anchor_id"]).select("id", "label", "vector", "windows"), "anchors-with-positives")

    def other_labels(anchors, ids, label, windows, parts):
        asked = windows.to_pylist()
        lo, hi = np.ones((len(ids), positives), object), np.zeros((len(ids), positives), object)
        for i, row in enumerate(asked):
            for w, p in enumerate(row):
                lo[i, w], hi[i, w] = -(-low * p["score"] // 100), high * p["score"] // 100  # whole scores within the window
        if max(np.abs(lo).max(), np.abs(hi).max()) < 2**53:
            lo, hi = lo.astype(np.float64), hi.astype(np.float64)
        wanted = Wanted(lo, hi, negatives)
        for rows_, row_ids, row_label in parts:
            scan(anchors, rows_, row_ids, label[:, None] != row_label, wanted)
        out = [
            (int(a), p["id"], p["score"], c, clip(-s))
            for a, row, best in zip(ids, asked, wanted.best, strict=True)
            for p, found in zip(row, best, strict=False)
            for s, c in found
        ]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)], names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    hits = meet(known, "windows", "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", other_labels)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return hits.select("anchor_id", "positive_id", rank.alias("rank"), "negative_id", "positive_score", "negative_score").where(F.col("rank") <= negatives)
