"""Near-duplicate components by b-bit MinHash, confirmed on full shingle sets.

1. Per document, in one pass: the number of distinct word shingles, a hash of its
   word sequence, the minima of ``bands * rows`` hash functions. Each is mixed over
   its 32 bits and the low ``BITS`` bits are kept, packed, as signature; before that
   each band of minima becomes a 64-bit key.
2. Candidates: documents with one word sequence are one node. Nodes that share a
   band key are joined to the key's smallest node (a star, never all pairs); the
   stars' components are candidate clusters.
3. Inside a candidate cluster the packed signatures, without any text, are compared in
   blocks of ``sketch_block`` nodes: a small cluster is one block, a larger one (pages
   of one template, a hot group of copies) is dealt out as pairs of blocks, so no task
   holds more than two. Bit counts give the collision-corrected similarity; pairs well
   below the threshold are passed over. Sets of up to ``SMALL`` shingles, for which an
   estimate is coarse, travel whole and are compared with each other exactly. A
   spanning forest of the pairs that are left splits the cluster into those nodes whose
   texts are worth a look; most clusters of merely alike texts fall apart here. A cluster
   that is one block is settled in its task; only the forests of larger ones are joined
   by ``connected``.
4. The texts of what is left are dealt in the same way, in blocks of ``block`` nodes, and
   pairs are decided on their full sets, unless already linked. Links leave as a
   spanning forest.
5. Components of the links; every document gets the smallest doc_id of its own. Facts of the
   few large clusters are broadcast (their number is checked), so no join meets a large
   cluster's nodes in one task.

Defined cases: text that is NULL or has no word has an empty set and is linked
with nothing; fewer words than a shingle make one shingle; rows with equal word
sequences are always linked, and rows that repeat a doc_id keep their own rows;
rows with a NULL doc_id are linked like others, and NULL is never the smallest
unless all are; extra columns are ignored; an empty table gives no rows. Shingles and sequences are compared by 64-bit hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, byte_table, gram_hashes, mix, row_key, small_batches, sorted_groups, staged, text_parts, word_hashes, word_spans
from .components import EDGE, connected

BITS = 2
BLOCK = 256
SKETCH_BLOCK = 4096
#: sets of up to so many shingles are compared without the estimate
SMALL = 64
#: large clusters whose facts are broadcast, at most
BROADCAST_CLUSTERS = 500_000
#: bytes of a staged node without its signature and set
NODE = 64
#: how far below the threshold an estimate may be and the pair still be checked (six standard errors)
ERRORS = 6.0
#: chance that a pair just at the threshold shares no band
MISS = 2e-5

_WORD = byte_table()


class Scheme:
    """Bands and rows for a threshold (in percent) and a shingle size."""

    def __init__(self, shingle: int, percent: int, miss: float = MISS):
        t = percent / 100
        self.shingle, self.percent = shingle, percent
        self.rows = max(1, round(math.log(0.32) / math.log(t))) if t < 1 else 8
        self.bands = max(1, math.ceil(math.log(miss) / math.log(max(1e-12, 1 - t**self.rows)))) if t < 1 else 1
        self.hashes = self.rows * self.bands
        rng = np.random.RandomState(97)
        self.a = rng.randint(0, 2**31 - 1, self.hashes).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.randint(0, 2**32 - 1, self.hashes, dtype=np.int64).astype(np.uint32)
        c = 2.0**-BITS
        m = t + (1 - t) * c
        self.estimate_from = t - ERRORS * math.sqrt(m * (1 - m) / self.hashes) / (1 - c)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct shingle hashes of each text, and a hash of its word sequence (0: no word)."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, _WORD)
    words = word_hashes(data, starts, ends)
    grams = gram_hashes(words, k)
    out, whole = [], np.zeros(len(offsets) - 1, np.uint64)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if a == b:
            out.append(np.zeros(0, np.uint64))
            continue
        whole[i] = gram_hashes(words[a:b], b - a)[0] | np.uint64(1)
        if b - a < k:
            out.append(whole[i : i + 1])
            continue
        g = np.sort(grams[a : b - k + 1])
        out.append(g[np.concatenate(([True], g[1:] != g[:-1]))])
    return out, whole


def minima(sets: list[np.ndarray], scheme: Scheme) -> np.ndarray:
    """Rows: texts with a non-empty set; columns: the least value of each hash function."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    out = np.empty((len(sets), scheme.hashes), np.uint32)
    v = np.empty_like(flat)
    for j in range(scheme.hashes):
        np.multiply(flat, scheme.a[j], out=v)
        v += scheme.b[j]
        out[:, j] = np.minimum.reduceat(v, first)
    return out


def mix32(h: np.ndarray) -> np.ndarray:
    """Every bit of a 32-bit value over all bits (one to one)."""
    h = h ^ (h >> np.uint32(16))
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def packed(mins: np.ndarray) -> np.ndarray:
    """Low BITS bits of each minimum, as whole 64-bit words. The low bits of a*x+b
    depend on those of x alone, for every hash function; so the minima are mixed first."""
    n, k = mins.shape
    mins = mix32(mins)
    bits = np.zeros((n, -(-k * BITS // 64) * 64), np.uint8)
    for i in range(BITS):
        bits[:, i : k * BITS : BITS] = (mins >> np.uint32(i)) & np.uint32(1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def similarity(one: np.ndarray, many: np.ndarray, hashes: int) -> np.ndarray:
    """Estimated resemblance of one packed signature and others: equal BITS-bit
    fields are counted and corrected for fields equal by chance."""
    differ = one ^ many
    any_bit = differ.copy()
    for i in range(1, BITS):
        any_bit |= differ >> np.uint64(i)
    unit = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    equal = 1 - np.bitwise_count(any_bit & unit).sum(-1) / hashes
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


class SmallSets:
    """Exact numbers of shingles in common among the sets of up to SMALL shingles."""

    def __init__(self, sets: list[np.ndarray], size: np.ndarray):
        self.small = size <= SMALL
        few = np.flatnonzero(self.small)
        self.first = np.concatenate(([0], np.cumsum(size[few])))
        self.place = np.cumsum(self.small) - 1
        self.shingle = np.unique(np.concatenate([sets[i] for i in few]), return_inverse=True)[1] if len(few) else few

    def shared(self, i: int) -> np.ndarray:
        """For small set i: shingles in common with each small set after it."""
        p = self.place[i]
        mark = np.zeros(len(self.shingle), bool)
        mark[self.shingle[self.first[p] : self.first[p + 1]]] = True
        rest = self.first[p + 1 : -1]
        if not len(rest):
            return np.zeros(0, np.int64)
        return np.add.reduceat(mark[self.shingle[rest[0] :]].astype(np.int64), rest - rest[0])


def sketch(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, row (hash of id and text), n_shingles, node (hash of the word sequence, NULL without
    words), bands, signature (packed) and set (the shingles, if at most SMALL)."""
    small_batches(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("row", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("signature", T.BinaryType()),
            T.StructField("set", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_parts(batch.column(2)):
                sets, whole = shingle_sets(data, offsets, scheme.shingle)
                size = np.fromiter(map(len, sets), np.int64, len(sets))
                some = np.flatnonzero(size)
                keys = np.zeros((0, scheme.bands), np.uint64)
                signature: list[bytes | None] = [None] * len(sets)
                if len(some):
                    mins = minima([sets[i] for i in some], scheme)
                    for i, s in zip(some.tolist(), packed(mins), strict=True):
                        signature[i] = s.tobytes()
                    mins = mins.reshape(len(some), scheme.bands, scheme.rows).astype(np.uint64)
                    keys = np.broadcast_to(np.arange(1, scheme.bands + 1, dtype=np.uint64), mins.shape[:2]).copy()
                    for r in range(scheme.rows):
                        keys = mix(keys ^ mins[:, :, r] * np.uint64(0x9E3779B97F4A7C15))
                first = np.concatenate(([0], np.cumsum(np.where(size > 0, scheme.bands, 0))))
                few = [s if len(s) <= SMALL else s[:0] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(size),
                        pa.array(whole.view(np.int64), mask=size == 0),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(keys.reshape(-1).view(np.int64))),
                        pa.array(signature, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(s) for s in few]))), pa.int32()), pa.array(np.concatenate([*few, np.zeros(0, np.uint64)]).view(np.int64))),
                    ],
                    names=schema.names,
                )

    return docs.select("doc_id", row_key("doc_id", "text").alias("row"), "text").mapInArrow(run, schema)


def near_later(i: int, signature: np.ndarray, size: np.ndarray, exact: SmallSets, scheme: Scheme) -> np.ndarray:
    """Which nodes after i may be linked with it: by the estimate, or exactly where both sets are small."""
    near = similarity(signature[i], signature[i + 1 :], scheme.hashes) >= scheme.estimate_from
    if exact.small[i]:
        later = np.flatnonzero(exact.small[i + 1 :])
        both = exact.shared(i)
        near[later] = 100 * both >= scheme.percent * (size[i] + size[i + 1 :][later] - both)
    return near & (100 * np.minimum(size[i], size[i + 1 :]) >= scheme.percent * np.maximum(size[i], size[i + 1 :]))


FOREST = "a long, b long, whole boolean"


def _forest(node: np.ndarray, root: np.ndarray, found: list[tuple[int, int]], whole: bool) -> pa.RecordBatch:
    """What a group gives: for a whole cluster each linked node (a) with the least of its component (b), else the links found.
    root: an index of the component for each node."""
    if whole:
        _, of, n = np.unique(root, return_inverse=True, return_counts=True)
        least = np.full(len(n), np.iinfo(np.int64).max)
        np.minimum.at(least, of, node)
        linked = n[of] > 1
        a, b = node[linked], least[of][linked]
    else:
        pairs = np.array(found).reshape(-1, 2)
        a, b = node[pairs[:, 0]], node[pairs[:, 1]]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), whole))], names=["a", "b", "whole"])


def _candidates(groups, scheme: Scheme):
    """Spanning forests of the pairs of a group that the signatures do not rule out."""
    for group in groups:
        alone = group.column("blocks")[0].as_py() == 1
        node = group.column("node").to_numpy()
        at = np.unique(node, return_index=True)[1]
        if len(at) < 2:
            continue
        node, half, size = node[at], group.column("half").to_numpy()[at], group.column("n_shingles").to_numpy()[at]
        held = group.column("signature").take(pa.array(at)).to_pylist()
        signature = np.frombuffer(b"".join(held), np.uint64).reshape(len(at), -1)
        sets = [np.array(s, np.int64).view(np.uint64) for s in group.column("set").take(pa.array(at)).to_pylist()]
        exact = SmallSets(sets, size)
        apart = bool((half == 1).any())
        root = np.arange(len(at))
        found: list[tuple[int, int]] = []
        for i in range(len(at) - 1):
            near = near_later(i, signature, size, exact, scheme)
            if apart:
                near &= half[i + 1 :] != half[i]
            later = np.flatnonzero(near) + i + 1
            for r in np.unique(root[later]).tolist():
                if r != root[i]:
                    found.append((i, int(later[root[later] == r][0])))
                    root[root == r] = root[i]
        if found:
            yield _forest(node, root, found, alone)


def _links(groups, scheme: Scheme):
    """Spanning forests of the confirmed links inside each group of nodes."""
    for group in groups:
        alone = group.column("blocks")[0].as_py() == 1
        texts = group.column("text").combine_chunks()
        sets: list[np.ndarray] = []
        whole: list[np.ndarray] = []
        for _, _, data, offsets in text_parts(texts):
            s, w = shingle_sets(data, offsets, scheme.shingle)
            sets += s
            whole.append(w)
        node = np.concatenate(whole).view(np.int64)
        # a text that is not its node's (row hashes that collide), or a node twice, doesn't count
        mine = np.flatnonzero(node == group.column("node").to_numpy())
        mine = mine[np.unique(node[mine], return_index=True)[1]]
        half = group.column("half").to_numpy()[mine]
        node, sets = node[mine], [sets[i] for i in mine]
        if len(sets) < 2:
            continue
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        signature = packed(minima(sets, scheme))
        root = np.arange(len(sets))
        found: list[tuple[int, int]] = []
        apart = (half == 1).any()
        exact = SmallSets(sets, size)
        for i in range(len(sets)):
            near = near_later(i, signature, size, exact, scheme)
            other = half[i + 1 :] != half[i] if apart else True
            for j in (np.flatnonzero(near & other) + i + 1).tolist():
                if root[i] == root[j]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= scheme.percent * (int(size[i] + size[j]) - both):
                    root[root == root[j]] = root[i]
                    found.append((i, j))
        if found:
            yield _forest(node, root, found, alone)


def _large(clusters: DataFrame, block: int, n_nodes: int, *facts) -> tuple[DataFrame, int]:
    """(root, n, facts) of the clusters of more than ``block`` of at most ``n_nodes`` nodes, and how many these are: at most
    nodes / block, counted before they are broadcast."""
    large = staged(clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n"), *facts).where(F.col("n") > block), "large-clusters", n_nodes * NODE)
    n = large.count()
    return F.broadcast(large) if n <= BROADCAST_CLUSTERS else large, n


def _components(forest: DataFrame, large: int, label: str) -> DataFrame:
    """(node, root) of the groups' forests; the links of clusters dealt out in several blocks are followed, if there are such clusters."""
    forest = staged(forest, f"{label}-forest")
    settled = forest.where("whole").select(F.col("a").alias("node"), F.col("b").alias("root"))
    return settled.unionByName(connected(forest.where("NOT whole").select("a", "b"), most=forest.count())) if large else settled


def _dealt(placed: DataFrame, block: int, columns: list[str]) -> DataFrame:
    """Nodes with their cluster's ``n``, as pairs of blocks (i, j); half tells the two blocks apart."""
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(block)).cast("int")
    pair = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    mine = placed.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    out = mine.select(*columns, "root", "blocks", "block", pair).select(
        *columns,
        "root",
        "blocks",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("half"),
    )
    return out.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, block: int = BLOCK, sketch_block: int = SKETCH_BLOCK) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, node, component_id (smallest
    doc_id of the component) and kept (doc_id is that one)."""
    scheme = Scheme(shingle, percent)
    rows = staged(sketch(docs, scheme), "sketches")
    nodes = rows.where("node IS NOT NULL")
    n = rows.count()

    # candidate clusters: stars around the smallest node of each band key
    keyed = nodes.select("node", F.explode("bands").alias("band"))
    shared = keyed.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("band", "least")
    shared = staged(shared, "shared-bands", n * scheme.bands * EDGE // 2)
    stars = keyed.join(shared, "band").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    clusters = connected(stars, most=n * scheme.bands)
    firsts = staged(nodes.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), *[F.min(c).alias(c) for c in ("n_shingles", "signature", "set")]), "nodes", n * (NODE + scheme.hashes * BITS // 8 + SMALL * 8))

    # the signatures alone split the clusters
    large, n_large = _large(clusters, sketch_block, n)
    sketched = clusters.join(large, "root", "left").join(firsts.drop("doc_id", "row"), "node")
    dealt = _dealt(sketched, sketch_block, ["node", "n_shingles", "signature", "set"])
    likely = dealt.mapInArrow(lambda batches: _candidates(sorted_groups(batches, ["root", "i", "j"]), scheme), FOREST)
    clusters = _components(likely, n_large, "likely")
    large, n_large = _large(clusters, block, n)
    placed = clusters.join(large, "root", "left").join(firsts.select("node", "row"), "node").select("row", "node", "root", "n")
    placed = staged(placed, "cluster-nodes", n * NODE)

    # one text meets each node, rows that repeat id and text are one (combined before the
    # shuffle); larger clusters go out as pairs of blocks
    once = docs.select(row_key("doc_id", "text").alias("row"), "text").groupBy("row").agg(F.min("text").alias("text"))
    texts = _dealt(once.join(placed.hint("merge"), "row"), block, ["text", "node"])
    links = texts.mapInArrow(lambda batches: _links(sorted_groups(batches, ["root", "i", "j"]), scheme), FOREST)
    labels = _components(links, n_large, "linked")

    ids = firsts.select("node", "doc_id")
    named = staged(labels.join(ids, "node"), "component-nodes", n * NODE)
    least = F.min("doc_id").alias("component_id")
    large = _large(named, block, n, least)[0].withColumn("large", F.lit(True))
    split = named.join(large.drop("n"), "root", "left")
    known = split.where("large").select("node", "component_id")
    others = split.where("large IS NULL").select("node", "root")
    small = named.groupBy("root").agg(F.count(F.lit(1)).alias("n"), least).where(F.col("n") <= block).select("root", "component_id")
    alone = ids.join(labels, "node", "left_anti").select("node", F.col("doc_id").alias("component_id"))
    of_node = staged(known.unionByName(others.join(small, "root").select("node", "component_id")).unionByName(alone), "node-components", n * NODE)
    out = rows.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", "node", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
