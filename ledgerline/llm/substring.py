"""Substring dedup: words of long passages that an earlier document also holds.

A window is ``window`` consecutive words; a word goes if a window that covers it
also starts in a document with a smaller doc_id. Windows are judged on the input.

1. One pass numbers words, and takes per document the distinct minimizers: least
   hash of every ``REACH`` consecutive ``GRAM``-word grams. Documents with equal
   word sequences are settled here: only the smallest doc_id of them goes on.
2. A window can recur only if all minimizers inside it occur in two documents or
   more (least and greatest doc_id per minimizer differ, aggregated map-side).
   Runs of such windows become segments, cut where the least gram changes, and
   are keyed by that gram: equal windows always meet under one key. Equal
   segments under a key are one, with their smallest doc_id.
3. Segments are dealt by key into shards of bounded size. Each shard builds a
   compressed FM-index (wavelet matrix) of its segments, streams them through it
   and gets matching statistics by backward search; a match of ``window`` words
   gives an interval, whose smallest doc_id is the window's first document.
   A key with very many different segments (a hot group of near copies) is cut
   finer, by least grams in further orders and at last window by window, so no
   shard grows with a group.
4. Intervals whose first document is smaller go back to their documents, the
   covered words are merged and removed.

Words are runs of bytes other than ASCII white space, unchanged.

Defined cases: NULL text has no words; a text of fewer than ``window`` words is
kept whole; a row without doc_id is kept whole and is never the earlier one; rows
that repeat a doc_id count as one document against each other; extra columns are
ignored; an empty table gives no rows. Words are compared by 64-bit hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, gram_hashes, mix, small_batches, sorted_groups, staged, text_parts, word_hashes, word_spans
from .fmindex import FMIndex

WINDOW = 50
GRAM = 8
SHARD_WORDS = 64_000
LEAST_SHARDS = 64
#: words of different segments under one key beyond which its segments are cut finer
HOT_WORDS = 4 * SHARD_WORDS
#: the level at which they are cut into single windows
LEVELS = 4

_WORD = byte_table()


def _reach(window: int) -> int:
    return max(1, (window - GRAM + 2) // 2)


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while span * 2 <= size:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (size - span)], x[size - span :])


def minimizers(words: np.ndarray, window: int) -> np.ndarray:
    """Least gram hash of each run of grams, for every place of one text where a run fits."""
    reach = _reach(window)
    if len(words) < window:
        return np.zeros(0, np.uint64)
    return _sliding_min(gram_hashes(words, GRAM), reach)


def candidate_segments(words: np.ndarray, window: int, shared: np.ndarray) -> list[tuple[int, int, int]]:
    """(first word, number of words, key) of the runs of windows that may recur.
    shared: sorted minimizers that occur in several documents."""
    least = minimizers(words, window)
    n = len(words) - window + 1
    if n <= 0 or not len(shared):
        return []
    at = np.minimum(np.searchsorted(shared, least), len(shared) - 1)
    alone = np.concatenate(([0], np.cumsum(shared[at] != least)))
    across = window - GRAM + 1 - _reach(window)  # runs inside a window start at its first places, this many more
    good = alone[across + 1 : across + 1 + n] == alone[:n]
    key = np.minimum(least[:n], least[across : across + n])
    edge = np.flatnonzero(np.concatenate(([True], (good[1:] != good[:-1]) | (key[1:] != key[:-1]), [True])))
    return [(a, b - a + window - 1, int(key[a])) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) if good[a]]


def _each(texts) -> tuple:
    """Words (bytes) and their hashes of each text of an Arrow column."""
    for _, _, data, offsets in text_parts(texts):
        starts, ends, first = word_spans(data, offsets, _WORD)
        hashes = word_hashes(data, starts, ends)
        raw = data.tobytes()
        for i in range(len(offsets) - 1):
            yield raw[offsets[i] : offsets[i + 1]].split(), hashes[first[i] : first[i + 1]]


def _digest(content: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(content, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _rows(fields: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _sketch(docs: DataFrame, window: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, sha, first, grams = [], [], [0], []
            for words, hashes in _each(batch.column("text")):
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                grams.append(np.unique(minimizers(hashes, window)))
                first.append(first[-1] + len(grams[-1]))
            flat = np.concatenate([*grams, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat))],
                names=["doc_id", "row", "n_words", "sha", "grams"],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(run, f"doc_id {kind}, row long, n_words long, sha string, grams array<long>")


def _segment_rows(candidates: DataFrame, window: int, with_content: bool) -> DataFrame:
    """Segments of the candidate documents: doc_id, row, start, words, key, c1, c2 (content digest) and content."""
    kind = candidates.schema["doc_id"].dataType.simpleString()
    fields = [("start", pa.int64()), ("words", pa.int64()), ("key", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64())]
    if with_content:
        fields.append(("content", pa.binary()))

    def run(batches):
        for batch in batches:
            shared = batch.column("shared")
            rows, owner = [], []
            for i, (words, hashes) in enumerate(_each(batch.column("text"))):
                have = np.sort(shared[i].values.to_numpy().view(np.uint64))
                for start, n, key in candidate_segments(hashes, window, have):
                    content = b" ".join(words[start : start + n])
                    signed = key - (1 << 64) if key >= 1 << 63 else key
                    rows.append((start, n, signed, *_digest(content), *([content] if with_content else [])))
                    owner.append(i)
            made = _rows(fields, rows)
            take = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("row").take(take), *made.columns], names=["doc_id", "row", *[n for n, _ in fields]])

    schema = f"doc_id {kind}, row long, start long, words long, key long, c1 long, c2 long" + (", content binary" if with_content else "")
    return candidates.mapInArrow(run, schema)


def _cut(segments: DataFrame, window: int, level: int, keep: list[str]) -> DataFrame:
    """Segments of hot keys cut again: where the least gram in another order changes,
    which becomes part of the key, and at the last level into single windows."""
    fields = [("start", pa.int64()), ("words", pa.int64()), ("key", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("content", pa.binary())]
    schema = ", ".join(f"{c} {segments.schema[c].dataType.simpleString()}" for c in keep) + ", start long, words long, key long, c1 long, c2 long, content binary"
    order = np.uint64(0x9E3779B97F4A7C15) * np.uint64(2 * level + 1)

    def run(batches):
        for batch in batches:
            rows, owner = [], []
            starts, keys = batch.column("start").to_pylist(), batch.column("key").to_numpy().view(np.uint64)
            for i, (words, hashes) in enumerate(_each(_text_of(batch.column("content")))):
                other = _sliding_min(mix(gram_hashes(hashes, GRAM) ^ order), window - GRAM + 1)
                if level >= LEVELS:
                    edge = np.arange(len(other) + 1)
                else:
                    edge = np.flatnonzero(np.concatenate(([True], other[1:] != other[:-1], [True])))
                key = mix(other ^ keys[i : i + 1]).view(np.int64)
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    part = b" ".join(words[a : b + window - 1])
                    c1, c2 = _digest(part)
                    rows.append((starts[i] + a, b - a + window - 1, c1 if level >= LEVELS else int(key[a]), c1, c2, part))
                    owner.append(i)
            made = _rows(fields, rows)
            take = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in keep], *made.columns], names=[*keep, *[n for n, _ in fields]])

    return segments.mapInArrow(run, schema)


def _text_of(content) -> pa.Array:
    """Binary column of valid UTF-8 as text."""
    if isinstance(content, pa.ChunkedArray):
        content = content.combine_chunks()
    return content.cast(pa.large_binary()).cast(pa.large_string())


def _first_documents(shards, window: int):
    """Per segment of a shard: the smallest doc_id of each of its windows, found in the shard's index."""
    for shard in shards:
        hashes = [h for _, h in _each(_text_of(shard.column("content")))]
        size = np.fromiter(map(len, hashes), np.int64, len(hashes))
        symbols = np.unique(np.concatenate(hashes), return_inverse=True)[1].reshape(-1).astype(np.int64) + 1
        first = np.concatenate(([0], np.cumsum(size)))
        owner = np.repeat(np.arange(len(size)), size)
        text = np.zeros(len(symbols) + len(size), np.int64)  # a separator after each segment
        text[np.arange(len(symbols)) + owner] = symbols
        doc = shard.column("first").to_numpy()
        of_place = np.full(len(text) + 1, np.iinfo(np.int64).max, np.int64)
        of_place[np.arange(len(symbols)) + owner] = doc[owner]
        index = FMIndex(text, window)
        length, where = index.matching_statistics(symbols, first, window)
        least = index.least_in_runs(of_place, window)[where]
        full = length >= window
        n = np.add.reduceat(full, first[:-1])
        yield pa.RecordBatch.from_arrays(
            [shard.column(c).combine_chunks() for c in ("key", "c1", "c2")] + [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(least[full]))],
            names=["key", "c1", "c2", "firsts"],
        )


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id (long), n_words, n_removed, kept_sha256 and kept (the kept words
    joined by blanks; NULL where nothing was removed) of every row."""
    small_batches(docs.sparkSession)
    known = staged(_sketch(docs.select("doc_id", "text"), window), "sketches")
    able = known.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    same = able.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("sha", "first")
    same = staged(same, "equal-texts")
    marked = able.join(same, "sha", "left").select("doc_id", "row", "grams", (F.col("first") < F.col("doc_id")).alias("copy"))
    marked = staged(marked, "marked")
    copies = marked.where("copy").select("doc_id", "row").distinct()
    single = marked.where("copy IS NULL OR NOT copy").select("doc_id", "row", "grams")

    # minimizers that occur in several documents, and each document's share of them
    gram = single.select("doc_id", "row", F.explode("grams").alias("gram"))
    shared = gram.groupBy("gram").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("gram")
    shared = staged(shared, "shared-grams")
    per_doc = gram.join(shared, "gram").groupBy("doc_id", "row").agg(F.collect_set("gram").alias("shared"))
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row"), "text")
    candidates = staged(texts.join(per_doc.hint("merge"), ["doc_id", "row"]), "candidates")

    # different segments under each key, with their first document; hot keys are cut finer
    key = ["key", "c1", "c2"]
    different = lambda rows, first: staged(rows.groupBy(*key).agg(F.min(first).alias("first"), F.min("content").alias("content"), F.min("words").alias("words")), "segments")
    whole = _segment_rows(candidates, window, True)
    distinct = different(whole, "doc_id")
    uses = _segment_rows(candidates, window, False).select("doc_id", "row", "start", *key)
    for level in range(2, LEVELS + 1):
        hot = staged(distinct.groupBy("key").agg(F.sum("words").alias("n")).where(F.col("n") > HOT_WORDS).select("key"), "hot-keys")
        if not hot.head(1):
            break
        finer = _cut(distinct.join(hot, "key").withColumn("start", F.lit(0).cast("long")), window, level, ["first"])
        distinct = staged(distinct.join(hot, "key", "left_anti").unionByName(different(finer, "first")), "segments")
        whole = _cut(whole.join(hot, "key"), window, level, ["doc_id", "row"])
        uses = uses.join(hot, "key", "left_anti").unionByName(whole.select(*uses.columns))

    words = distinct.agg(F.sum("words").alias("n")).first()["n"] or 0
    shards = max(LEAST_SHARDS, -(-words // SHARD_WORDS))
    dealt = distinct.select("key", "c1", "c2", F.col("first").cast("long").alias("first"), "content", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard")
    found = staged(dealt.mapInArrow(lambda batches: _first_documents(sorted_groups(batches, ["shard"]), window), "key long, c1 long, c2 long, firsts array<long>"), "first-documents")

    later = uses.join(found, ["key", "c1", "c2"]).where(F.exists("firsts", lambda f: f < F.col("doc_id")))
    hits = later.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "firsts")).alias("hits"))
    cut = _removed(candidates.select("doc_id", "row", "text").join(hits, ["doc_id", "row"]), window)
    cut = cut.dropDuplicates(["doc_id", "row"])
    empty = hashlib.sha256(b"").hexdigest()
    gone = cut.unionByName(copies.select("doc_id", "row", F.lit(-1).cast("long").alias("n_removed"), F.lit(empty).alias("kept_sha256"), F.lit("").alias("kept")))
    gone = staged(gone, "removed").withColumnsRenamed({"doc_id": "__doc", "row": "__row"})
    out = known.join(gone, (F.col("doc_id") == F.col("__doc")) & (F.col("row") == F.col("__row")), "left")
    removed = F.when(F.col("n_removed") < 0, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return out.select("doc_id", "n_words", removed.cast("long").alias("n_removed"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")


def _removed(rows: DataFrame, window: int) -> DataFrame:
    """Merge each document's covered words and take them out."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = []
            for i, (words, _) in enumerate(_each(batch.column("text"))):
                edge = np.zeros(len(words) + 1, np.int64)
                for hit in batch.column("hits")[i].as_py():
                    at = np.flatnonzero(np.array(hit["firsts"]) < ids[i]) + hit["start"]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                keep = np.cumsum(edge[:-1]) == 0
                kept = b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)
                out.append((int(len(words) - keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            made = _rows([("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())], out)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *made.columns], names=["doc_id", "row", "n_removed", "kept_sha256", "kept"])

    return rows.mapInArrow(run, f"doc_id {kind}, row long, n_removed long, kept_sha256 string, kept string")
