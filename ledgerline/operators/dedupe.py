"""Dedupe by key with a fixed survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), watermark: tuple[str, str] | None = None
) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` values (e.g.
    ``ingestion_timestamp``), remaining ties broken by the other columns.

    Written as ``max(struct(order…, rest…))`` grouped by key instead of a
    ``row_number`` window: the max is combined map-side before the shuffle, so
    a key holding a third of all rows costs one partial row per task, not a
    single task sorting all of them.

    On a streaming frame this is ``dropDuplicates(keys)``: the first arrival
    survives and later copies are dropped against the query's state (T6).
    The state is unbounded, as in the reference, unless ``watermark``
    ``(event_time_column, delay)`` is given: then duplicates are dropped
    within the watermark and old keys leave the state."""
    keys = list(keys)
    if df.isStreaming:
        if watermark:
            # watermarks need TIMESTAMP; wall-clock (NTZ) event times are read as session-zone time
            col, delay = watermark
            marked = df.withColumn("_event_time", F.col(col).cast("timestamp")).withWatermark("_event_time", delay)
            return marked.dropDuplicatesWithinWatermark(keys).drop("_event_time")
        return df.dropDuplicates(keys)
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_survivor")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_survivor.{c}").alias(c) for c in order + rest]).select(*df.columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedupe (A15); partial distinct runs before the shuffle."""
    return df.dropDuplicates()
