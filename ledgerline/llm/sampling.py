"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of text that a sample may hold, as it is brought to the driver.
SAMPLE_BYTES = 64 << 20


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text modulo n: which rows are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def bounded(rows: DataFrame, total: int, text: str | None = None, max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``total`` rows and ``max_bytes`` of ``text``, whatever the rows are, in the order of a
    hash of their whole content: rows alike in all columns share a hash, so a choice by
    the hash alone would take all of a group of copies or none."""
    turn = "__turn"
    chosen = rows.withColumn(turn, F.xxhash64(F.lit("sample"), *rows.columns)).orderBy(turn).limit(total)
    if text is not None:
        # a window over ``total`` rows at most
        used = F.sum(F.octet_length(text)).over(Window.orderBy(turn).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        chosen = chosen.withColumn("__used", used).where(F.col("__used") <= max_bytes).drop("__used")
    return chosen.drop(turn)


def per_class(rows: DataFrame, label: str, limit: int, total: int, text: str | None = None, max_bytes: int = SAMPLE_BYTES) -> tuple[DataFrame, dict]:
    """Rows chosen by a hash of their whole content, about ``limit`` of each class, within
    ``bounded``; and the classes' counts."""
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    each = max(1, min(limit, total // max(1, len(counts))))
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, each / n))).otherwise(share)
    dice = F.pmod(F.xxhash64(F.lit("dice"), *rows.columns), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return bounded(rows.where(dice < share), total, text, max_bytes), counts
