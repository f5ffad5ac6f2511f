"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is lower-cased (ASCII) and every run of 3 and of 5 bytes that lies in one
word, with the blank before or after it, is hashed to a bucket with an
embedding. The embeddings' mean goes through a linear softmax. Embeddings and
weights are learned by minibatch stochastic gradient descent in numpy on a
bounded sample (``per_lang`` rows of each language, ``max_sample`` in all; whole
texts and short spans of them). A part of the sample is kept for calibration: a
temperature, and the rejection threshold, below which at most ``reject_share`` of
known texts fall (never above ``reject_cap``).

Every whole text is scored where it lies; the model (buckets x languages) is
all that tasks receive. A prediction depends on that text alone.

Defined cases: text that is NULL or has no letter is ``und`` with score 0 and
rejected; a text without any subword gets the prior; without labelled rows all
texts are ``und``, and only those without a letter rejected; one known language is predicted for all; repeated rows and
extra columns change nothing; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, small_batches, text_parts
from .sampling import per_class

UNKNOWN = "und"
BUCKET_BITS = 14
DIM = 16
GRAMS = (3, 5)
PER_LANG = 600
MAX_SAMPLE = 20_000

_CLEAN = LOWER.copy()
_CLEAN[[b for b in range(128) if not chr(b).isalpha()]] = 32
_ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_KEYS = (np.random.RandomState(11).randint(0, 2**31 - 1, 8).astype(np.uint32) << np.uint32(1)) | np.uint32(1)


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of each text, text by text, and where each text's begin."""
    clean = _CLEAN[data]
    wide = clean.astype(np.uint32)
    blank = clean == 32
    text_of_end = np.zeros(len(data) + 1, np.int32)
    np.add.at(text_of_end, offsets[1:-1], 1)
    text_of_end = np.cumsum(text_of_end[:-1], dtype=np.int32)  # text of each byte
    places, buckets = [], []
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        h = wide[:m] * _KEYS[0]
        for j in range(1, n):
            h += wide[j : j + m] * _KEYS[j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B) + np.uint32(2 * n)
        inner = ~blank[1 : 1 + m]
        for j in range(2, n - 1):
            inner &= ~blank[j : j + m]
        inner &= text_of_end[:m] == text_of_end[n - 1 :]
        keep = np.flatnonzero(inner)
        places.append(text_of_end[keep])
        buckets.append((h[keep] >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
    if not places:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    text = np.concatenate(places)
    order = np.argsort(text, kind="stable")
    return np.concatenate(buckets)[order], np.searchsorted(text[order], np.arange(len(offsets)))


def _mean_rows(table: np.ndarray, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of the table's rows over each text's buckets (zero if it has none)."""
    out = np.zeros((len(first) - 1, table.shape[1]))
    n = np.diff(first)
    some = n > 0
    if some.any():
        out[some] = np.add.reduceat(table[buckets], first[:-1][some], axis=0, dtype=np.float64) / n[some, None]
    return out


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data])))
    out = np.diff(seen[offsets]) > 0
    wide = np.concatenate(([0], np.cumsum(data >= 128)))
    for i in np.flatnonzero(~out & (np.diff(wide[offsets]) > 0)):
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


class Model:
    """logits: bucket table times weights (the model is linear in the mean)."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, threshold: float):
        self.langs, self.table, self.bias, self.threshold = langs, table, bias, threshold

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language (-1: und) and calibrated probability of each text."""
        logits = _mean_rows(self.table, *subwords(data, offsets)) + self.bias
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        known = has_letter(data, offsets)
        return np.where(known, best, -1), np.where(known, p[np.arange(len(best)), best], 0.0)


def _spans(text: str, rng: np.random.RandomState) -> list[str]:
    """The whole text and two short spans of it, for texts of any length."""
    words = text.split()
    out = [text]
    for n in (rng.randint(1, 6), rng.randint(6, 40)):
        if len(words) > n:
            s = rng.randint(0, len(words) - n + 1)
            out.append(" ".join(words[s : s + n]))
    return out


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    buckets, counts = [], []
    for _, _, data, offsets in text_parts(pa.array(texts, pa.large_string())):
        b, first = subwords(data, offsets)
        buckets.append(b)
        counts.append(np.diff(first))
    return np.concatenate([*buckets, np.zeros(0, np.int32)]), np.concatenate([[0], np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)]))]).astype(np.int64)


def train(rows: list[tuple[str, str]], epochs: int = 5, batch: int = 32, rate: float = 4.0, reject_share: float = 0.0005, reject_cap: float = 0.4, seed: int = 5) -> Model | None:
    """rows: (language, text), in any order."""
    rows = sorted(rows)
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return None
    size = 1 << BUCKET_BITS
    rng = np.random.RandomState(seed)
    kept_out = rng.rand(len(rows)) < 0.2
    which = {lang: i for i, lang in enumerate(langs)}
    texts: list[str] = []
    target: list[int] = []
    for (lang, text), out in zip(rows, kept_out, strict=True):
        if not out:
            for span in _spans(text, rng):
                texts.append(span)
                target.append(which[lang])
    y = np.array(target, np.int64)
    buckets, first = _features(texts)
    embed = rng.uniform(-1, 1, (size, DIM)).astype(np.float32) / DIM
    weights = rng.uniform(-1, 1, (DIM, len(langs))).astype(np.float32) / DIM
    bias = np.zeros(len(langs), np.float32)
    steps = max(1, epochs * -(-len(y) // batch))
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(order), batch):
            pick = order[s : s + batch]
            n = first[pick + 1] - first[pick]
            row = np.repeat(np.arange(len(pick)), n)
            used = buckets[np.concatenate([np.arange(first[i], first[i + 1]) for i in pick])]
            share = (1.0 / np.maximum(n, 1)).astype(np.float32)
            cols, col = np.unique(used, return_inverse=True)
            x = np.bincount(row * len(cols) + col, minlength=len(pick) * len(cols)).reshape(len(pick), -1).astype(np.float32) * share[:, None]
            hidden = x @ embed[cols]
            z = hidden @ weights + bias
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            g = p / len(pick)
            step = rate * (1 - done / steps)
            grad_hidden = g @ weights.T
            weights -= step * (hidden.T @ g)
            bias -= 0.1 * step * g.sum(0)
            embed[cols] -= step * 16 * (x.T @ grad_hidden)
            done += 1
    # calibration on texts that were not learned from
    held = [(lang, text) for (lang, text), out in zip(rows, kept_out, strict=True) if out] or rows
    table = embed @ weights
    spans, truth, whole = [], [], []
    for lang, text in held:
        for k, span in enumerate(_spans(text, rng)):
            spans.append(span)
            truth.append(which[lang])
            whole.append(k == 0)
    b, f = _features(spans)
    logits = _mean_rows(table, b, f) + bias
    truth, whole = np.array(truth), np.array(whole)

    def likelihood(t: float) -> tuple[float, np.ndarray]:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        return float(-np.log(p[np.arange(len(truth)), truth] + 1e-12).mean()), p

    best = min(np.geomspace(0.2, 5, 33), key=lambda t: likelihood(t)[0])
    top = likelihood(best)[1][whole].max(1)
    threshold = min(reject_cap, float(np.quantile(top, reject_share)))
    return Model(langs, (table / best).astype(np.float32), (bias / best).astype(np.float64), threshold)


def fit(docs: DataFrame, learn_from: Column | None = None, per_lang: int = PER_LANG, max_sample: int = MAX_SAMPLE) -> Model | None:
    """Train on a bounded sample of the rows with text and lang (and ``learn_from``)."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if learn_from is not None:
        rows = rows.where(learn_from)
    sample, _ = per_class(rows.select("doc_id", "lang", "text"), "lang", per_lang, max_sample, "text")
    return train([(r["lang"], r["text"]) for r in sample.select("lang", "text").collect()])  # max_sample rows and SAMPLE_BYTES at most


def identify(docs: DataFrame, model: Model | None, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (default all) with lang_pred, lang_score, lang_rejected."""
    small_batches(docs.sparkSession)
    kept = docs.columns if columns is None else columns
    added = [("lang_pred", T.StringType()), ("lang_score", T.DoubleType()), ("lang_rejected", T.BooleanType())]
    clash = {n for n, _ in added} & set(kept)
    if clash:
        docs, kept = docs.drop(*clash), [c for c in kept if c not in clash]
    source = docs.select(*kept, F.col("text").alias("__text"))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in added])
    names = np.array([*(model.langs if model else []), UNKNOWN], object)

    def score(batches):
        for batch in batches:
            pred, prob, known = np.full(batch.num_rows, -1), np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for lo, hi, data, offsets in text_parts(batch.column(len(kept))):
                if model is None:
                    known[lo:hi] = has_letter(data, offsets)
                else:
                    pred[lo:hi], prob[lo:hi] = model.predict(data, offsets)
            reject = (pred < 0) | (prob < model.threshold) if model else ~known
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(names[pred], pa.string()), pa.array(prob), pa.array(reject)], names=schema.names)

    return source.mapInArrow(score, schema)
