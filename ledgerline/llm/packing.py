"""Best-fit sequence packing planned over a histogram of lengths.

1. Texts become token ids plus an end id; longer ones are cut into pieces of
   ``max_len`` (the first piece takes the remainder). Only piece rows (a few
   numbers each, or the ids too if asked) are staged.
2. Spark counts pieces per length: at most ``max_len`` counts. Best-fit
   decreasing runs over those counts, not over pieces: a run of equal pieces goes
   at once into the fullest open sequences that still fit it. Its outcome is a
   list of slot runs (length, ranks, sequences, place).
3. Each piece gets its rank among the pieces of its length (salted: counts per
   length and salt, then ranks inside), and takes the planned slot of that rank.

Defined cases: NULL text is empty, and an empty text is one piece holding only
the end id; rows repeating a doc_id (or with a NULL one) are packed each on
their own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, staged, text_parts
from .tokens import encoder

MAX_LEN = 2048
END_ID = 0
PIECES_PER_SALT = 50_000


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID, keep_ids: bool = False, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, with
    ``keep_ids``, the ids as little-endian unsigned 32-bit bytes. ranks_path: see
    ``tokens.Encoder``."""
    small_batches(docs.sparkSession)
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)

    def cut(batches):
        model = encoder(tokenizer_path, ranks_path)
        for batch in batches:
            texts = batch.column(1)
            for lo, hi, _, _ in text_parts(texts):
                flat, first = model.encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                row, number, start, length, crc, raw = [], [], [], [], [], []
                for i in range(hi - lo):
                    ids = np.append(flat[first[i] : first[i + 1]], np.uint32(end_id)).astype("<u4")
                    a, b = 0, (len(ids) - 1) % max_len + 1
                    k = 0
                    while a < len(ids):
                        data = ids[a:b].tobytes()
                        row.append(lo + i)
                        number.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(data))
                        if keep_ids:
                            raw.append(data)
                        a, b, k = b, b + max_len, k + 1
                cols = [batch.column(0).take(pa.array(row, pa.int32())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if keep_ids:
                    cols.append(pa.array(raw, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> np.ndarray:
    """Best-fit decreasing over counts. Rows: length, first rank, first sequence,
    pieces per sequence, place in the sequence; a run ends where the next of its
    length begins. Sequences are numbered from 0."""
    open_runs: list[list[tuple[int, int]]] = [[] for _ in range(max_len + 1)]  # by room left: (first sequence, how many)
    has = np.zeros(max_len + 1, bool)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            open_runs[room].append((first, n))
            has[room] = True

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            step = int(np.argmax(has[length:]))
            room = length + step
            if has[room]:
                first, n = open_runs[room].pop()
                has[room] = bool(open_runs[room])
            else:
                room = max_len
                first, n = sequences, -(-left // (max_len // length))
                sequences += n
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, first, each, max_len - room))
                rank, left = rank + full * each, left - full * each
                leave(room - each * length, first, full)
                first, n = first + full, n - full
            if n and left and left < each:
                runs.append((length, rank, first, left, max_len - room))
                leave(room - left * length, first, 1)
                rank, left = rank + left, 0
                first, n = first + 1, n - 1
            leave(room, first, n)
    return np.array(runs, np.int64).reshape(-1, 5)


def assign(piece_rows: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Add sequence_id and offset to staged piece rows."""
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in piece_rows.columns]
    histogram = {r["length"]: r["n"] for r in piece_rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(histogram, max_len)
    # piece ranks within a length start over at 0: one sorted key finds the run of (length, rank)
    by = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[by]
    stride = max(histogram.values(), default=0) + 1
    run_key = runs[:, 0] * stride + runs[:, 1]

    salts = max(1, -(-sum(histogram.values()) // PIECES_PER_SALT), 64)
    salted = piece_rows.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    before = (
        salted.groupBy("length", "__salt")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "__salt", F.coalesce("__before", F.lit(0)).alias("__before"))
    )
    inside = F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*order)) - 1
    ranked = salted.withColumn("__inside", inside).join(before, ["length", "__salt"]).withColumn("__rank", F.col("__before") + F.col("__inside"))
    ranked = ranked.select(*piece_rows.columns, F.col("__rank").cast("long").alias("__rank"))
    schema = T.StructType([*piece_rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    own = piece_rows.columns

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False)
            run = runs[np.searchsorted(run_key, length * stride + rank, "right") - 1] if len(runs) else np.zeros((len(rank), 5), np.int64)
            step = rank - run[:, 1]
            each = np.maximum(run[:, 3], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in own] + [pa.array(run[:, 2] + step // each), pa.array(run[:, 4] + step % each * length)],
                names=schema.names,
            )

    return ranked.mapInArrow(place, schema)


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID, keep_ids: bool = False, ranks_path: str | None = None) -> DataFrame:
    """Piece rows of ``pieces`` with sequence_id and offset: best-fit packed."""
    return assign(staged(pieces(docs, tokenizer_path, max_len, end_id, keep_ids, ranks_path), "pieces"), max_len)
