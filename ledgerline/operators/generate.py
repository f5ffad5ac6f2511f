"""Batch model hooks: text generation (M4), reply parsing (M5, M6) and
embeddings (R2).

A model is a plain Python function over a pandas Series, run by
``mapInPandas`` on Arrow batches inside the tasks, so calls scale out with the
partitions and no row passes through the driver. Without a model the default
is a deterministic JVM-side template (no Python worker, no network), which
keeps every decision reproducible; inputs and outputs stay columns of the
result so they are persisted with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

TextModel = Callable[[pd.Series], pd.Series]


GIVE_UP = 3  # single prompts that fail one after another: the model is taken to be down for the chunk


def _safe_apply(fn: TextModel, prompts: pd.Series, size: int | None = None) -> tuple[list, list]:
    """Replies and errors. The model is called on chunks of at most ``size`` prompts (the whole
    batch when unset); if a chunk's call fails, that chunk is retried prompt by prompt. A prompt that
    fails alone has no reply (the reference skips such rows) and its error's text."""
    step = size or max(len(prompts), 1)
    replies: list = []
    errors: list = []
    for i in range(0, len(prompts), step):
        chunk = prompts.iloc[i : i + step]
        try:
            replies += list(fn(chunk))
            errors += [None] * len(chunk)
            continue
        except Exception:  # noqa: BLE001 — which prompt is to blame shows below
            failed = 0
        for p in chunk:
            if failed < GIVE_UP:
                try:
                    replies.append(list(fn(pd.Series([p])))[0])
                    errors.append(None)
                    failed = 0
                    continue
                except Exception as e:  # noqa: BLE001 — kept in the error column
                    said = f"{type(e).__name__}: {e}"
                    failed += 1
            replies.append(None)
            errors.append(said)
    return [None if pd.isna(r) else r for r in replies], errors


def generate_text(
    df: DataFrame,
    prompt_col: str,
    out_col: str,
    model: TextModel | None = None,
    default: Column | None = None,
    batch_size: int | None = None,
    error_col: str | None = None,
) -> DataFrame:
    """Add ``out_col`` = model(prompt) per row.

    ``model=None`` uses ``default`` (a Column expression, e.g. a template over
    the row's fields) and stays in the JVM. ``batch_size`` caps the prompts
    per model call; a failing call is retried row by row for its chunk only.
    ``error_col`` names a column for what went wrong with a row's call."""
    if model is None:
        if default is None:
            raise ValueError("need a model or a default expression")
        out = df.withColumn(out_col, default)
        return out.withColumn(error_col, F.lit(None).cast("string")) if error_col else out
    added = [out_col, *([error_col] if error_col else [])]
    fields = [f for f in df.schema.fields if f.name not in added]
    schema = StructType(fields + [StructField(c, StringType(), True) for c in added])
    names = [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[names].copy()
            replies, errors = _safe_apply(model, pdf[prompt_col], batch_size)
            pdf[out_col] = pd.Series(replies, index=pdf.index, dtype=object)
            if error_col:
                pdf[error_col] = pd.Series(errors, index=pdf.index, dtype=object)
            yield pdf

    return df.mapInPandas(run, schema)


def parse_reply(reply: Column, key: str, missing: str) -> Column:
    """JSON reply → the text under ``key``.

    A JSON object without ``key`` gives ``missing``; text that is not a JSON
    object gives NULL (the reference drops such replies)."""
    obj = F.from_json(reply, "map<string,string>")
    return F.when(obj.isNotNull(), F.coalesce(F.try_element_at(obj, F.lit(key)), F.lit(missing)))


def with_fallback(text: Column, fallback: str) -> Column:
    """Empty or missing model text → fixed fallback (M6)."""
    return F.when(F.length(F.trim(text)) > 0, text).otherwise(F.lit(fallback))
