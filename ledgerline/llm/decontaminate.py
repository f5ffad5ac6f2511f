"""Benchmark decontamination over a distributed positional inverted index.

``positional_index`` keeps, per block of documents, the postings (positions) of
every term of the test set, sorted by term: one row per block, so the index is
spread like the corpus and no posting list is ever gathered. Corpus-wide term
counts come from it. ``search`` runs each test window in every block: the list
of its rarest term is shifted by the term's offset and intersected with the
lists of the next rarest terms, each shifted by its own offset, until all terms
agree (exact phrase). A proximity match needs every other term of the window
within ``window - 1 + slop`` words of an occurrence of the rarest one.

Words: ASCII letters lower-cased, runs of digits, letters and non-ASCII bytes.
A window is ``window`` consecutive words of a test item; an item with fewer
words, but not none, is one window.

Defined cases: NULL or wordless text has no words and no hits; items without
words match nothing; items without id give hits, but no entry in item_ids or
near_item_ids; rows repeating an item_id are one item; rows repeating a
doc_id are judged row by row; extra columns are ignored; empty tables give an
empty or all-clean result. Terms are compared by 64-bit hash.

Test sets of more than ``max_test_words`` words run in blocks of items of about
that size, one index each, and the blocks' results are merged; the plan sent to
the tasks is thus bounded.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, byte_table, small_batches, staged, text_parts, word_hashes, word_spans

WINDOW = 10
SLOP = 5
MAX_TEST_WORDS = 200_000
BLOCK_BYTES = 4 << 20

_WORD = byte_table(word_bytes=[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])

_INTS = T.ArrayType(T.IntegerType())


def _hashed(data, offsets):
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, _WORD)
    return word_hashes(data, starts, ends), first


def _index_schema(doc_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(doc_type)),
            T.StructField("n_words", _INTS),
            T.StructField("terms", _INTS),
            T.StructField("counts", _INTS),
            T.StructField("positions", _INTS),
        ]
    )


def positional_index(docs: DataFrame, vocabulary: np.ndarray, gap: int) -> DataFrame:
    """Postings of the terms in ``vocabulary`` (sorted hashes), one row per block.
    Document i of a block starts at the sum over earlier ones of words + ``gap``,
    so that no match can span two documents."""
    small_batches(docs.sparkSession)

    def build(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in text_parts(batch.column(1), BLOCK_BYTES):
                words, first = _hashed(data, offsets)
                n = np.diff(first)
                where = np.repeat(np.cumsum(n + gap) - (n + gap) - first[:-1], n) + np.arange(len(words))
                at = np.searchsorted(vocabulary, words)
                at[at == len(vocabulary)] = 0
                hit = vocabulary[at] == words if len(vocabulary) else np.zeros(len(words), bool)
                terms, where = at[hit].astype(np.int32), where[hit]
                order = np.argsort(terms, kind="stable")
                present, counts = np.unique(terms, return_counts=True)
                one = lambda a, kind: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a, kind))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([base + number], pa.int64()),
                        one(ids.slice(lo, hi - lo), ids.type),
                        one(n.astype(np.int32), pa.int32()),
                        one(present.astype(np.int32), pa.int32()),
                        one(counts.astype(np.int32), pa.int32()),
                        one(where[order].astype(np.int32), pa.int32()),
                    ],
                    names=["block", "doc_ids", "n_words", "terms", "counts", "positions"],
                )
                number += 1

    return docs.select("doc_id", "text").mapInArrow(build, _index_schema(docs.schema["doc_id"].dataType))


class Plan:
    """Distinct windows of a bounded set of test items, in terms of the vocabulary."""

    def __init__(self, item_ids: list[str | None], texts: list[str], window: int):
        col = pa.array(texts, pa.large_string())
        per_item: list[np.ndarray] = []
        for _, _, data, offsets in text_parts(col):
            words, first = _hashed(data, offsets)
            per_item += [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.vocabulary = np.unique(np.concatenate([*per_item, np.zeros(0, np.uint64)]))
        rows: list[np.ndarray] = []
        owner: list[int] = []
        names = sorted({name for name in item_ids if name is not None})  # rows that repeat an id are one item
        number = {name: i for i, name in enumerate([*names, None])}
        for item, words in zip(item_ids, per_item, strict=True):
            i = number[item]
            terms = np.searchsorted(self.vocabulary, words).astype(np.int32)
            for s in range(max(1, len(terms) - window + 1) if len(terms) else 0):
                row = np.full(window, -1, np.int32)
                part = terms[s : s + window]
                row[: len(part)] = part
                rows.append(row)
                owner.append(i)
        table = np.array(rows, np.int32).reshape(-1, window)
        self.windows, which = np.unique(table, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.reshape(-1), np.array(owner, np.int64)], 1), axis=0) if owner else np.zeros((0, 2), np.int64)
        pairs = pairs[pairs[:, 1] < len(names)]  # windows of items without id have no owner to list
        self.owners, self.owner_first = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        self.lengths = (self.windows >= 0).sum(1)
        self.item_ids = np.array(names, object)
        self.order = np.zeros_like(self.windows)

    def rank(self, counts: dict[int, int]) -> None:
        """Order each window's places by corpus count, rarest first."""
        n = np.array([counts.get(i, 0) for i in range(len(self.vocabulary))] + [np.iinfo(np.int64).max], np.int64)
        self.order = np.argsort(n[self.windows], axis=1, kind="stable").astype(np.int32)


def _intersect(plan: Plan, keys: np.ndarray, span: int, first: dict, window: int, reach: int):
    """(window, start) of exact matches and (window, place) of proximity matches."""
    term_at, count_at = first
    rows = np.arange(len(plan.windows))
    rare = plan.windows[rows, plan.order[:, 0]]
    slot = np.searchsorted(term_at, rare)
    slot[slot == len(term_at)] = 0
    found = term_at[slot] == rare if len(term_at) else np.zeros(len(rare), bool)
    rows, slot = rows[found], slot[found]
    starts = np.concatenate(([0], np.cumsum(count_at)))
    n = count_at[slot]
    take = np.repeat(starts[slot], n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
    place = keys[take] % span
    win = np.repeat(rows, n)
    exact_w, exact_s = win, place - plan.order[win, 0]
    near_w, near_p = win, place
    for k in range(1, window):
        if len(exact_w):
            o = plan.order[exact_w, k]
            t = plan.windows[exact_w, o].astype(np.int64)
            probe = t * span + exact_s + o
            at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
            ok = (t < 0) | (keys[at] == probe)
            exact_w, exact_s = exact_w[ok], exact_s[ok]
        if len(near_w):
            t = plan.windows[near_w, plan.order[near_w, k]].astype(np.int64)
            low = t * span + np.maximum(near_p - reach, 0)
            at = np.searchsorted(keys, low)
            ok = (t < 0) | ((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] <= t * span + near_p + reach))
            near_w, near_p = near_w[ok], near_p[ok]
    return exact_w, exact_s, near_w, near_p


def search(index: DataFrame, plan: Plan, window: int, slop: int, gap: int) -> DataFrame:
    """Per document: merged hit spans (in words), items with an exact match and
    items with a proximity match."""
    doc_type = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("doc_id", doc_type),
            T.StructField("block", T.LongType()),
            T.StructField("place", T.IntegerType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("hits", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
            T.StructField("item_ids", T.ArrayType(T.StringType())),
            T.StructField("near_item_ids", T.ArrayType(T.StringType())),
        ]
    )
    reach = window - 1 + slop

    def listed(doc: np.ndarray, win: np.ndarray, n_docs: int) -> pa.ListArray:
        n = plan.owner_first[win + 1] - plan.owner_first[win]
        items = plan.owners[np.repeat(plan.owner_first[win], n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))]
        pairs = np.unique(np.stack([np.repeat(doc, n), items], 1), axis=0) if len(items) else np.zeros((0, 2), np.int64)
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs[:, 0], np.arange(n_docs + 1)), pa.int32()), pa.array(plan.item_ids[pairs[:, 1]], pa.string()))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column("block")[row].as_py()
                part = {c: batch.column(c)[row].values for c in ("doc_ids", "n_words", "terms", "counts", "positions")}
                n, terms, counts, places = (part[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n_words", "terms", "counts", "positions"))
                begin = np.cumsum(n + gap) - (n + gap)
                span = int((n + gap).sum()) + 1
                keys = np.repeat(terms, counts) * span + places
                ew, es, nw, npl = _intersect(plan, keys, span, (terms, counts), window, reach)
                edge = np.zeros(span + 1, np.int32)
                np.add.at(edge, es, 1)
                np.add.at(edge, es + plan.lengths[ew], -1)
                covered = np.cumsum(edge) > 0
                step = np.diff(np.concatenate(([0], covered.view(np.int8), [0])))
                a, b = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                doc = np.searchsorted(begin, a, "right") - 1
                spans = pa.StructArray.from_arrays([pa.array(a - begin[doc], pa.int64()), pa.array(b - begin[doc], pa.int64())], names=["start", "end"])
                n_docs = len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_ids"],
                        pa.array(np.full(n_docs, block), pa.int64()),
                        pa.array(np.arange(n_docs), pa.int32()),
                        pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n_docs + 1)), pa.int32()), spans),
                        listed(np.searchsorted(begin, es, "right") - 1, ew, n_docs),
                        listed(np.searchsorted(begin, npl, "right") - 1, nw, n_docs),
                    ],
                    names=schema.names,
                )

    return index.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, max_test_words: int = MAX_TEST_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, hits (merged word spans of exact
    matches), item_ids and near_item_ids (distinct, as strings)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // (2 * max_test_words)))  # a word takes two characters or more
    gap = 2 * window + slop
    found = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64(F.coalesce("item_id", "text")), F.lit(blocks)) == b).collect() if blocks > 1 else items.collect()
        plan = Plan([r["item_id"] for r in rows], [r["text"] for r in rows], window)
        index = staged(positional_index(docs, plan.vocabulary, gap), "postings")
        counts = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("n"))
        plan.rank({r["terms"]: r["n"] for r in counts.collect()})  # one row for each term of the bounded plan
        found.append(search(index, plan, window, slop, gap))
    if blocks == 1:
        return found[0].drop("block", "place")
    return _merged(reduce(DataFrame.unionByName, found))


def _merged(parts: DataFrame) -> DataFrame:
    """Results of several blocks of items: one row per document again. The
    index is built from the same scan for each, so (block, place) is one document."""
    gathered = parts.groupBy("block", "place", "doc_id", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"),
        F.array_distinct(F.flatten(F.collect_list("near_item_ids"))).alias("near_item_ids"),
    )
    kind = parts.schema["hits"].dataType.simpleString()

    def join(acc, h):
        last = F.element_at(acc, -1)
        return F.when(
            (F.size(acc) > 0) & (h["start"] <= F.try_element_at(acc, F.lit(-1))["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], h["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(h)))

    return gathered.withColumn("hits", F.aggregate("hits", F.array().cast(kind), join)).drop("block", "place")


__all__ = ["decontaminate", "positional_index", "search", "Plan"]
