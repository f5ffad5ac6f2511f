"""Ranked lexical search of an item set over all documents by dual-tree search.

A document is a sparse vector over the items' terms (its integer term weight by
term count and length), an item the vector of its terms' rarity weights; the score is
their inner product. Both sides get hierarchies whose nodes hold coordinate maxima:
no document of a node scores more with any item of another than the inner product
of the two nodes' maxima. Node pairs whose bound is below the weakest k-th score
among the node's items are dropped whole; what is left is opened on both sides down to
single documents and items, where the bound is the score itself.

Passes: (1) one Arrow pass over the texts turns each into its counts of item terms, a
few dozen integers, written once; (2) counts of documents and words, and document
frequencies; (3) rounds of search over that copy without a shuffle: a task builds trees
of TREE documents and returns at most k rows an item. The first rounds search shares of
1 in 64 only to learn each item's k-th score, which the next round starts from; the last
searches everything and alone gives the result, so a table of any size passes on some
64 k rows an item.

Words: A-Z is lowered, then maximal runs of ``0-9a-z`` and of characters beyond ASCII.
Defined cases: a NULL or empty text has no terms and is not counted; every row is
a document of its own, also if it repeats an id or a whole row; rows without an id come
after others of the same score; items of one id (also of none) are one item with the
terms of all; an item without terms, or whose terms no document has, has no rows; extra
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from .common import LOWER, byte_table, ranges, small_batches, staged, text_parts, word_hashes, word_spans

BOOK_TERMS = 1_000_000  # (item, term) pairs sent to the tasks at once; more items go in further books
BLOCK_ITEMS = 256  # items of one tree
TREE = 4096  # documents of one tree, fewer
TREE_ENTRIES = 1 << 20  # once they hold so many terms
DOC_NODE = (512, 64, 8, 1)  # documents of a node, from the root's children down
ITEM_NODE = (64, 16, 4, 1)
ROUND = 64  # a round searches this many times the documents of the one before
LEAST = 512  # documents of the first round at least
EXPAND = 1 << 21  # products worked out at once
EXACT = 2**53  # float64 sums of integers below are exact in any order

WORD_BYTES = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]


# ---- inside tasks ---------------------------------------------------------------------------------


def term_hashes(col) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes of all words, index of each row's first word) of runs of texts."""
    is_word = byte_table(word_bytes=WORD_BYTES)
    for lo, hi, data, offsets in text_parts(col):
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets, is_word)
        yield lo, hi, word_hashes(data, starts, ends), first


def lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values, kind))


class Nodes:
    """Sparse coordinate maxima of the nodes of one level: entries sorted by
    (node, term), each pair once."""

    def __init__(self, node: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, terms: int):
        key = node * terms + term
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        self.value = np.maximum.reduceat(value, at) if len(at) else value
        self.node, self.term = np.divmod(key[at], terms)
        self.n, self.first = n, np.searchsorted(self.node, np.arange(n + 1))

    def merged(self, group: int, terms: int) -> "Nodes":
        """Nodes of ``group`` neighbours each."""
        return Nodes(self.node // group, self.term, self.value, -(-self.n // group), terms)


class ItemTree:
    """Items of a block, neighbours alike, and for each level the nodes that hold a term."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int):
        """item: 0..n-1 and term: 0.. of each pair; weight: of each term."""
        self.terms, self.weight, self.n = len(weight), weight, n
        rarest = np.zeros(n, np.int64)
        order = np.lexsort((weight[term], item))
        rarest[item[order]] = term[order]  # the last of an item is its weightiest term
        self.items = np.lexsort((np.arange(n), rarest))
        place = np.empty(n, np.int64)
        place[self.items] = np.arange(n)
        self.levels = []
        for size in ITEM_NODE:
            pairs = np.unique(term * -(-n // size) + place[item] // size)
            holds, node = np.divmod(pairs, -(-n // size))
            self.levels.append((node, np.searchsorted(holds, np.arange(self.terms + 1)), -(-n // size)))
        longest = np.bincount(item, weight[term].astype(np.float64), n).max(initial=0)
        self.whole = longest * 1e6 >= EXACT  # scores too large for float64: sums stay 64-bit integers

    def bounds(self, docs: Nodes, which: np.ndarray, level: int) -> np.ndarray:
        """Inner products of the maxima of document nodes ``which`` and all item nodes of the level."""
        node, first, n = self.levels[level]
        out = np.zeros(len(which) * n, np.int64 if self.whole else np.float64)
        count = docs.first[which + 1] - docs.first[which]
        entry, owner = ranges(docs.first[which], count), np.repeat(np.arange(len(which)), count)
        degree = np.diff(first)[docs.term[entry]]
        cuts = np.searchsorted(np.cumsum(degree), np.arange(EXPAND, degree.sum() + EXPAND, EXPAND), "left") + 1
        edges = [0, *np.minimum(cuts, len(entry)).tolist()]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            e, d = entry[a:b], degree[a:b]
            to = np.repeat(owner[a:b] * n, d) + node[ranges(first[docs.term[e]], d)]
            part = np.repeat(docs.value[e] * self.weight[docs.term[e]], d)
            if self.whole:
                np.add.at(out, to, part)
            else:
                out += np.bincount(to, part, len(out))
        return out.reshape(len(which), n)


class Best:
    """The k best documents of each item of a block so far, and the score to beat."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = np.maximum(floor, 1), k  # only scores above 0 count
        self.item, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), None

    def add(self, item: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        if not len(item):
            return
        ids = pa.concat_arrays([self.id, ids]) if self.id is not None else ids
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        rank = pc.rank(ids, "ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64)
        order = np.lexsort((rank, -score, item))
        first = np.searchsorted(item[order], item[order])
        keep = order[np.arange(len(order)) - first < self.k]
        self.item, self.score, self.id = item[keep], score[keep], ids.take(pa.array(keep))
        last = np.searchsorted(self.item, np.arange(len(self.floor)), "right") - 1
        full = np.bincount(self.item, minlength=len(self.floor)) >= self.k
        self.floor[full] = np.maximum(self.floor[full], self.score[last[full]])


def search(tree: ItemTree, best: Best, levels: list[Nodes], ids: pa.Array) -> int:
    """Dual-tree search of one document tree; returns how many pairs were scored."""
    scored = 0
    floor = best.floor[tree.items]  # in the tree's order
    least = lambda size: np.minimum.reduceat(floor, np.arange(0, tree.n, size))
    top = levels[0]
    bound = tree.bounds(top, np.arange(top.n), 0)
    for root in np.argsort(-bound.max(1, initial=0), kind="stable").tolist():  # promising nodes first, so that the scores to beat rise soon
        floor = best.floor[tree.items]
        alive, which = bound[root : root + 1] >= least(ITEM_NODE[0]), np.array([root])
        for depth in range(1, len(DOC_NODE)):
            some = alive.any(1)
            which, alive = which[some], alive[some]
            if not len(which):
                break
            step, docs = DOC_NODE[depth - 1] // DOC_NODE[depth], levels[depth]
            below = which[:, None] * step + np.arange(step)
            there = (below < docs.n).ravel()
            parents = np.repeat(alive, ITEM_NODE[depth - 1] // ITEM_NODE[depth], 1)[:, : tree.levels[depth][2]]
            which, parents = below.ravel()[there], np.repeat(parents, step, 0)[there]
            scores = tree.bounds(docs, which, depth)
            alive = parents & (scores >= least(ITEM_NODE[depth]))
            if depth == len(DOC_NODE) - 1:
                scored += int(parents.sum())
                doc, item = np.nonzero(alive)
                best.add(tree.items[item], scores[doc, item].astype(np.int64), ids.take(pa.array(which[doc])))
    return scored


def doc_weights(tf: np.ndarray, n: np.ndarray, total_docs: int, total_words: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m), where m = 100 - 50 + (50 n N) div L."""
    n = n.astype(object) if 50 * int(n.max(initial=0)) * total_docs >= 2**63 else n
    m = (50 + (50 * n * total_docs) // total_words).astype(np.int64)
    return (10**9 * tf) // (1000 * tf + 20 * m)


# ---- the operator ---------------------------------------------------------------------------------


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's k best documents."""
    spark = docs.sparkSession
    small_batches(spark)
    docs, items = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text")), items.select(F.col(item_id).alias("item"), F.col(text).cast("string").alias("text"))
    item_type, doc_type = items.schema["item"].dataType, docs.schema["doc"].dataType

    def terms_of(batches):
        for b in batches:
            owner, term = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lo, hi, hashes, first in term_hashes(b.column("text")):
                owner.append(np.repeat(np.arange(lo, hi), np.diff(first)))
                term.append(hashes.view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(np.concatenate(owner))), pa.array(np.concatenate(term))], names=["item", "term"])

    wanted = staged(items.mapInArrow(terms_of, StructType([StructField("item", item_type), *StructType.fromDDL("term long")])).distinct(), "item-terms")
    books = max(1, -(-wanted.count() // BOOK_TERMS))
    book = F.pmod(F.xxhash64("item"), F.lit(books))
    found = None
    for i in range(books):  # as a rule one; each reads the documents once
        rows = _search_book(docs, wanted.where(book == i) if books > 1 else wanted, k, item_type, doc_type)
        found = rows if found is None else found.unionByName(rows)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return found.select(F.col("item").alias(item_id), rank.alias("rank"), F.col("doc").alias(doc_id), "score").where(F.col("rank") <= k)


def _search_book(docs: DataFrame, wanted: DataFrame, k: int, item_type, doc_type) -> DataFrame:
    pairs = wanted.toArrow()  # BOOK_TERMS rows, about
    codes = pairs.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    of, items = codes.indices.to_numpy().astype(np.int64), codes.dictionary
    vocabulary, term = np.unique(pairs.column("term").to_numpy(), return_inverse=True)

    def counts(batches):
        """Each text's number of words, and its counts of the items' terms."""
        for b in batches:
            at, n, size, terms, tfs = [], [], [], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for lo, hi, hashes, first in term_hashes(b.column("text")):
                hashes = hashes.view(np.int64)
                place = np.searchsorted(vocabulary, hashes)
                known = vocabulary[np.minimum(place, len(vocabulary) - 1)] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                owner = np.repeat(np.arange(hi - lo), np.diff(first))[known]
                key, tf = np.unique(owner * max(1, len(vocabulary)) + place[known], return_counts=True)
                owner, place = np.divmod(key, max(1, len(vocabulary)))
                size.append(np.bincount(owner, minlength=hi - lo))
                n.append(np.diff(first))
                terms.append(place.astype(np.int32))
                tfs.append(tf.astype(np.int64))
            n, size = np.concatenate(n or [np.zeros(0, np.int64)]), np.concatenate(size or [np.zeros(0, np.int64)])
            at = np.flatnonzero(n > 0)  # a text without words has no terms either
            yield pa.RecordBatch.from_arrays(
                [b.column("doc").take(pa.array(at)), pa.array(n[at]), lists(np.concatenate(terms), size[at], pa.int32()), lists(np.concatenate(tfs), size[at], pa.int64())],
                names=["doc", "n", "terms", "tfs"],
            )

    counted = staged(docs.mapInArrow(counts, StructType([StructField("doc", doc_type), *StructType.fromDDL("n long, terms array<int>, tfs array<long>")])), "item-term-counts")
    sums = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    total_docs, total_words = sums["docs"], max(1, sums["words"])
    df = np.zeros(len(vocabulary), np.int64)
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()  # no longer than the vocabulary
    df[held.column("term").to_numpy()] = held.column("df").to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    # blocks of items alike in their rarest term; each block knows its own terms only
    rarest = np.zeros(len(items), np.int64)
    order = np.lexsort((weight[term], of))
    rarest[of[order]] = term[order]
    turn = np.empty(len(items), np.int64)
    turn[np.argsort(rarest, kind="stable")] = np.arange(len(items))
    blocks = []
    for lo in range(0, len(items), BLOCK_ITEMS):
        mine = (turn[of] >= lo) & (turn[of] < lo + BLOCK_ITEMS) & (weight[term] > 0)  # a weight of 0 adds nothing
        own = np.unique(term[mine])
        number = np.flatnonzero((turn >= lo) & (turn < lo + BLOCK_ITEMS))
        blocks.append((number, own, ItemTree(np.searchsorted(number, of[mine]), np.searchsorted(own, term[mine]), weight[own], len(number))))

    schema = StructType([StructField("item", item_type), StructField("doc", doc_type), *StructType.fromDDL("score long")])
    arrow_item, arrow_doc = to_arrow_type(item_type), to_arrow_type(doc_type)

    def searcher(floors: np.ndarray):
        def run(batches):
            bests = [Best(floors[number], k) for number, _, _ in blocks]

            def flush(held: list[pa.RecordBatch]) -> None:
                t = pa.Table.from_batches(held)
                ids, n = t.column("doc").combine_chunks(), t.column("n").to_numpy()
                flat = lambda name: t.column(name).combine_chunks().flatten().to_numpy()
                size = np.diff(t.column("terms").combine_chunks().offsets.to_numpy())
                terms, owner = flat("terms").astype(np.int64), np.repeat(np.arange(len(n)), size)
                value = doc_weights(flat("tfs"), n[owner], total_docs, total_words)
                for (_, own, tree), best in zip(blocks, bests, strict=True):
                    if not len(own):
                        continue
                    place = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                    known = own[place] == terms
                    local, doc, v = place[known], owner[known], value[known]
                    # documents alike in their weightiest coordinate become neighbours
                    part = v * tree.weight[local]
                    lead, most = np.full(len(n), -1), np.zeros(len(n), np.int64)
                    by = np.lexsort((part, doc))
                    lead[doc[by]], most[doc[by]] = local[by], part[by]
                    turn = np.lexsort((-most, lead))
                    place = np.empty(len(n), np.int64)
                    place[turn] = np.arange(len(n))
                    levels = [Nodes(place[doc], local, v, len(n), len(own))]
                    for i in range(len(DOC_NODE) - 1, 0, -1):
                        levels.insert(0, levels[0].merged(DOC_NODE[i - 1] // DOC_NODE[i], len(own)))
                    search(tree, best, levels, ids.take(pa.array(turn)))

            held, rows, entries = [], 0, 0
            for b in batches:
                for lo in range(0, b.num_rows, TREE):
                    held.append(b.slice(lo, TREE))
                    rows += held[-1].num_rows
                    entries += len(held[-1].column("terms").flatten())
                    if rows >= TREE or entries >= TREE_ENTRIES:
                        flush(held)
                        held, rows, entries = [], 0, 0
            if held:
                flush(held)
            for (number, _, _), best in zip(blocks, bests, strict=True):
                if best.id is not None and len(best.item):
                    yield pa.RecordBatch.from_arrays([items.take(pa.array(number[best.item])).cast(arrow_item), best.id.cast(arrow_doc), pa.array(best.score)], names=["item", "doc", "score"])

        return run

    floors = np.zeros(len(items), np.int64)
    shares = []
    while total_docs / ROUND ** (len(shares) + 1) >= LEAST:
        shares.append(1 / ROUND ** (len(shares) + 1))
    dice = F.pmod(F.xxhash64(F.lit("round"), "doc", "n", "terms"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    for share in reversed(shares):
        seen = counted.where(dice < share).mapInArrow(searcher(floors), schema)
        # the k-th best score of an item among any rows is one that its k-th best of all cannot be below
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        kth = seen.select("item", "score", rank.alias("rank")).where(F.col("rank") == k).toArrow()  # a row an item of this book
        known = dict(zip(kth.column("item").to_pylist(), kth.column("score").to_pylist(), strict=True))
        floors = np.array([known.get(i, 0) for i in items.to_pylist()], np.int64)
    return counted.mapInArrow(searcher(floors), schema)
