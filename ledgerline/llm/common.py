"""Shared helpers: staging, Arrow text batches, vectorized byte hashing.

Text work runs in ``mapInArrow`` tasks on the UTF-8 bytes of a batch: words
are found with one table lookup per byte and hashed with prefix sums, so no
Python loop runs per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text handled at once inside a task (arrays are 8 bytes per byte).
CHUNK_BYTES = 1 << 20
#: Bytes that a task writes of a staged copy of known size.
STAGED_BYTES = 4 << 20

ASCII_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def small_batches(spark: SparkSession, records: int = 1000) -> None:
    """Arrow batches small enough for very long texts. A setting of the caller stays; one
    that an operator made is only ever lowered, so it does not matter which ran first."""
    name, mark = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.ledgerline.arrow.records"
    now = spark.conf.getAll
    if name not in now or now[name] == now.get(mark):
        least = str(min(records, int(now.get(mark, records))))
        spark.conf.set(name, least)
        spark.conf.set(mark, least)


def staged(df: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's checkpoint folder and read it
    back: lineage is cut there, and the copy outlives any executor. most: about the bytes
    it can come to; a small copy is then written by a task for each core, not by one for
    each shuffle partition. For frames whose last step is light and spread evenly."""
    spark = df.sparkSession
    if most is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-most // STAGED_BYTES)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """64-bit key of a row's content; used next to the id, so that rows which
    repeat an id with another text stay apart."""
    return F.xxhash64(*cols)


def fresh(df: DataFrame, *names: str) -> None:
    """Refuse input whose columns clash with working names (they start with ``__``)."""
    clash = sorted(set(df.columns) & set(names))
    if clash:
        raise ValueError(f"reserved column names in the input: {clash}")


# ---- Arrow text ---------------------------------------------------------------------------------


def text_parts(col, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets within bytes) of runs of rows of about
    ``max_bytes``; a longer text is a run of its own. NULL texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.type != pa.large_string():
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    lo, n = 0, len(col)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def byte_table(separators: Iterator[int] | None = None, word_bytes: Iterator[int] | None = None) -> np.ndarray:
    """256 booleans: is the byte part of a word."""
    if word_bytes is not None:
        out = np.zeros(256, dtype=bool)
        out[list(word_bytes)] = True
        return out
    out = np.ones(256, dtype=bool)
    out[list(separators or ASCII_SPACE)] = False
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each text, and ``first``: index of the
    first word of each text (one more entry than texts). Words never span texts."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    w = is_word[data]
    before = np.empty_like(w)
    before[0] = False
    before[1:] = w[:-1]
    after = np.empty_like(w)
    after[-1] = False
    after[:-1] = w[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# ---- hashing: sums of random byte values times powers of an odd number, modulo 2^64 -------------

_RNG = np.random.RandomState(20240611)
_BYTE = _RNG.randint(0, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_Q = np.uint64(0xD1B54A32D192ED03 | 1)
_Q_INV = np.uint64(pow(int(_Q), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2^64 (kept between calls)."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 22:
            _POWERS[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    return h


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span (independent of where it stands)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_P, len(data)), out=total[1:])
    h = (total[ends] - total[starts]) * powers(_P_INV, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (positions with fewer words left
    are dropped); texts are adjacent, so the caller drops grams that span two."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k <= 12:
        h = words[:n].copy()
        for i in range(1, k):
            h *= _Q
            h += words[i : i + n]
        return mix(h)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(_Q, len(words)), out=total[1:])
    return mix((total[k:] - total[:n]) * powers(_Q_INV, n))


def ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], .., first[0]+counts[0]-1, first[1], .. as one array."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(first - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return shift + np.arange(total)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal (non-NULL, integer) keys of sorted batches, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys], 1)
        cuts = np.flatnonzero((cols[1:] != cols[:-1]).any(1)) + 1
        if last is not None and (cols[0] != last).any():
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = cols[-1]
    if held:
        yield pa.Table.from_batches(held)
