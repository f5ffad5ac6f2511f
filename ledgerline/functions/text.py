"""Text helpers: tokenization and the model-free default embedding.

``hashed_term_counts`` is the built-in stand-in for a sentence-embedding
model: each lower-cased alphanumeric token (plural ``s`` dropped) adds 1 to bucket
``md5(token)[0:8] mod dim``. It is built only from SQL functions (one narrow
projection, no Python worker), is deterministic, and is reproducible in any
SQL engine with ``md5``. A real model plugs in through ``embed`` in
``operators.generate`` style (``embed_with``)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

# Token pattern, plural rule (a trailing "s" is dropped from
# tokens longer than PLURAL_MIN_LEN), embedding width.
TOKEN_SPLIT = "[^a-z0-9]+"
PLURAL_MIN_LEN = 3
EMBED_DIM = 128


def singular(token: Column) -> Column:
    return F.when(F.length(token) > PLURAL_MIN_LEN, F.regexp_replace(token, "s$", "")).otherwise(token)


def tokens(text: Column) -> Column:
    """Lower-cased alphanumeric words, plural ``s`` dropped (products → product)."""
    words = F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != F.lit(""))
    return F.transform(words, singular)


def token_bucket(token: Column, dim: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint"), F.lit(dim))


def hashed_term_counts(text: Column, dim: int = EMBED_DIM) -> Column:
    """Dense ``array<float>`` of token counts per hash bucket (small integers,
    exact in float32, so half the bytes of doubles on the way to the scorer).
    The buckets in order are folded into runs of zeros and counts, so a text costs its tokens, not
    tokens times ``dim``; each token is hashed once."""
    buckets = F.array_sort(F.transform(tokens(text), lambda t: token_bucket(t, dim)))
    zeros = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n.cast("int"))

    def dense(found: Column) -> Column:
        count = lambda b: F.array(F.size(F.filter(found, lambda x: x == b)).cast("float"))
        return F.aggregate(
            F.array_distinct(found),
            zeros(F.lit(0)),
            lambda acc, b: F.concat(acc, zeros(b - F.size(acc)), count(b)),
            lambda acc: F.concat(acc, zeros(F.lit(dim) - F.size(acc))),
        )

    # a lambda's variable is worked out once, however often it is used
    return F.element_at(F.transform(F.array(buckets), dense), 1)


EmbedModel = Callable[[pd.Series], list]


def embed_with(df: DataFrame, text_col: str, out_col: str, model: EmbedModel, batch_size: int | None = None) -> DataFrame:
    """Pluggable embedding hook (R2, R3): ``model`` maps a batch of texts to a
    list of vectors, run per Arrow batch inside the tasks, at most
    ``batch_size`` texts per call."""
    fields = [f for f in df.schema.fields if f.name != out_col]
    schema = StructType(fields + [StructField(out_col, ArrayType(DoubleType()), True)])
    names = [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[names].copy()
            texts = pdf[text_col]
            step = batch_size or max(len(texts), 1)
            vecs = [v for i in range(0, len(texts), step) for v in model(texts.iloc[i : i + step])]
            pdf[out_col] = [None if v is None else np.asarray(v, dtype=np.float64).tolist() for v in vecs]
            yield pdf

    return df.mapInPandas(run, schema)


def embed(
    df: DataFrame, text_col: str, out_col: str = "embedding", model: EmbedModel | None = None, dim: int = EMBED_DIM, batch_size: int | None = None
) -> DataFrame:
    """Embed a text column: the hashed default (JVM) or a supplied model."""
    if model is None:
        return df.withColumn(out_col, hashed_term_counts(F.col(text_col), dim))
    return embed_with(df, text_col, out_col, model, batch_size)
