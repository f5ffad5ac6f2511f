"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, ``FILTERS`` learned filters of ``WIDTH`` bytes slide over the
whole text (stride ``STRIDE``), and their responses are max-pooled over chunks of
two blocks that overlap by one block, from the first byte to the last. The
rectified chunk maxima, averaged and maximized over all chunks, enter one
logistic unit: one probability per document, however long.

Learned with Adam on a bounded sample (``per_class`` rows a label) of labelled
rows; a part of it calibrates the probability, weighted to the labels' shares.
Scoring runs where the text lies; only the weights go to the tasks. A score
depends on that text's bytes alone.

Defined cases: NULL text counts as empty, and an empty text gets a score like any
other; label rows with NULL or values other than 0 and 1 teach nothing; without
any labels every score is 0.5; if only one label occurs, every score is its
smoothed share; repeated rows and extra columns change nothing; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_parts
from .sampling import bounded, per_class

EMBED = 8
WIDTH = 8
STRIDE = 2
FILTERS = 32
BLOCK = 128  # positions; a chunk is two blocks
PER_CLASS = 1500
SPAN_SHARE = 0.3
PART_BYTES = 256 << 10


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with zeros after each text, so that windows at even places never mix
    texts; first place (in strides) and number of windows of each text."""
    size = np.diff(offsets)
    windows = np.maximum(1, -(-(size - WIDTH) // STRIDE) + 1)
    room = STRIDE * (windows - 1) + WIDTH
    begin = np.cumsum(room) - room
    out = np.zeros(int(room.sum()), np.uint8)
    out[np.repeat(begin - offsets[:-1], size) + np.arange(len(data))] = data
    return out, begin // STRIDE, windows


class Net:
    def __init__(self, seed: int = 3):
        rng = np.random.RandomState(seed)
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.filters = rng.normal(0, 0.2, (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(2 * FILTERS, np.float32)
        self.bias = np.zeros(1, np.float32)
        self.scale, self.offset = 1.0, 0.0  # calibration

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.out, self.bias]

    def responses(self, padded: np.ndarray) -> np.ndarray:
        """Filter responses at every STRIDE-th place of the padded bytes."""
        step = STRIDE * EMBED
        rows = self.embed[padded].reshape(-1, step)
        m = len(rows) - WIDTH // STRIDE + 1
        total = rows[:m] @ self.filters[:step]
        for j in range(1, WIDTH // STRIDE):
            total += rows[j : j + m] @ self.filters[j * step : (j + 1) * step]
        return total

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        padded, begin, windows = _padded(data, offsets)
        total = self.responses(padded)
        blocks = -(-windows // BLOCK)
        # per text: its block starts, then the place after its last window, whose maxima are dropped
        cuts = np.repeat(begin, blocks + 1) + np.minimum(_upto(blocks + 1) * BLOCK, np.repeat(windows, blocks + 1))
        cuts = np.minimum(cuts, len(total))
        real = np.flatnonzero(_upto(blocks + 1) < np.repeat(blocks, blocks + 1))
        peak = np.maximum.reduceat(np.vstack([total, np.full((1, FILTERS), -np.inf, np.float32)]), cuts, axis=0)[real]
        first = np.cumsum(blocks) - blocks
        last = first + blocks - 1
        chunk = np.maximum(peak, np.vstack([peak[1:], peak[-1:]]))  # block with the next one
        keep = np.ones(len(peak), bool)
        single = blocks == 1
        keep[last[~single]] = False
        chunk[first[single]] = peak[first[single]]
        chunk = np.maximum(chunk[keep] + self.shift, 0)
        chunks = np.maximum(blocks - 1, 1)
        at = np.cumsum(chunks) - chunks
        return np.hstack([np.add.reduceat(chunk, at, axis=0) / chunks[:, None].astype(np.float32), np.maximum.reduceat(chunk, at, axis=0)])

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return (self.features(data, offsets) @ self.out + self.bias[0]).astype(np.float64)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(data, offsets) + self.offset, -40, 40)))

    def gradients(self, text: bytes, label: int) -> list[np.ndarray]:
        """Gradient of the logistic loss of one text, by hand."""
        data = np.frombuffer(text, np.uint8)
        padded, _, windows = _padded(data, np.array([0, len(data)], np.int64))
        total = self.responses(padded)
        blocks = -(-len(total) // BLOCK)
        full = np.full((blocks * BLOCK, FILTERS), -np.inf, np.float32)
        full[: len(total)] = total
        full = full.reshape(blocks, BLOCK, FILTERS)
        arg = full.argmax(1)
        peak = np.take_along_axis(full, arg[:, None], 1)[:, 0]
        place = arg + (np.arange(blocks) * BLOCK)[:, None]
        if blocks > 1:
            later = peak[1:] > peak[:-1]
            chunk = np.where(later, peak[1:], peak[:-1])
            place = np.where(later, place[1:], place[:-1])
        else:
            chunk = peak
        live = chunk + self.shift
        value = np.maximum(live, 0)
        best = value.argmax(0)
        x = np.concatenate([value.mean(0), value.max(0)])
        p = 1 / (1 + np.exp(-float(np.clip(x @ self.out + self.bias[0], -40, 40))))
        g = np.float32(p - label)
        grad_value = np.broadcast_to(g * self.out[:FILTERS] / len(value), value.shape).copy()
        grad_value[best, np.arange(FILTERS)] += g * self.out[FILTERS:]
        grad_value *= live > 0
        # each chunk's maximum came from one window: bytes there get the gradient
        starts = STRIDE * place
        window = padded[starts[:, :, None] + np.arange(WIDTH)]  # chunks x filters x width
        seen = self.embed[window].reshape(*place.shape, WIDTH * EMBED)
        grad_filters = np.einsum("cf,cfw->wf", grad_value, seen)
        grad_seen = grad_value[:, :, None] * self.filters.T[None]
        grad_embed = np.zeros_like(self.embed)
        np.add.at(grad_embed, window.reshape(-1), grad_seen.reshape(-1, EMBED))
        return [grad_embed, grad_filters, grad_value.sum(0), g * x, np.array([g], np.float32)]


def _upto(counts: np.ndarray) -> np.ndarray:
    """0 .. counts[0]-1, 0 .. counts[1]-1, .."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def train(rows: list[tuple[int, str]], share: float, epochs: int = 5, batch: int = 16, rate: float = 0.01, seed: int = 3) -> Net | float:
    """rows: (label, text); share: share of label 1 among all labels. Without both
    labels: a constant score."""
    if len({label for label, _ in rows}) < 2:
        return share
    rows = [(label, text.encode()) for label, text in sorted(rows)]
    rng = np.random.RandomState(seed)
    out = rng.rand(len(rows)) < 0.2
    learn, held = [r for r, o in zip(rows, out, strict=True) if not o], [r for r, o in zip(rows, out, strict=True) if o]
    # a short span of a good text is good too: without it, shortness itself would count as bad
    for label, text in [r for r in learn if r[0] == 1 and rng.rand() < SPAN_SHARE]:
        words = text.split()
        n = rng.randint(1, 25)
        a = rng.randint(0, max(1, len(words) - n))
        learn.append((label, b" ".join(words[a : a + n])))
    net = Net(seed)
    mean, var = ([np.zeros_like(p) for p in net.params()] for _ in range(2))
    step = 0
    steps = max(1, epochs * -(-len(learn) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(learn))
        for s in range(0, len(order), batch):
            grads = [net.gradients(learn[i][1], learn[i][0]) for i in order[s : s + batch]]
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for p, m, v, g in zip(net.params(), mean, var, map(lambda x: sum(x) / len(grads), zip(*grads, strict=True)), strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    _calibrate(net, held if len({label for label, _ in held}) == 2 else learn, share)
    return net


def _calibrate(net: Net, rows: list[tuple[int, bytes]], share: float) -> None:
    """Platt scaling (ridge towards the identity) by Newton steps, labels weighted to their shares."""
    texts = pa.array([t for _, t in rows], pa.large_binary()).cast(pa.large_string(), safe=False)
    z = np.concatenate([net.logits(d, o) for _, _, d, o in text_parts(texts, PART_BYTES)])
    y = np.array([label for label, _ in rows], float)
    n1 = y.sum()
    w = np.where(y == 1, share / n1, (1 - share) / (len(y) - n1)) * len(y)
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(ab[0] * z + ab[1], -40, 40)))
        grad = np.array([(w * (p - y) * z).sum() + (ab[0] - 1), (w * (p - y)).sum()])
        q = w * p * (1 - p) + 1e-9
        hess = np.array([[(q * z * z).sum() + 1, (q * z).sum()], [(q * z).sum(), q.sum()]])
        move = np.linalg.solve(hess, grad)
        ab -= np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    net.scale, net.offset = float(max(ab[0], 1e-3)), float(ab[1])


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, per_label: int = PER_CLASS) -> Net | float:
    """Train on a bounded sample of the labelled rows (``learn_from`` is a filter on doc_id)."""
    rows = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    if learn_from is not None:
        rows = rows.where(learn_from)
    sample, counts = per_class(rows, "label", per_label, 2 * per_label)
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")  # 2 * per_label labels at most
    texts = bounded(texts, 2 * per_label, "text")  # an id may stand at any number of texts
    return train([(r["label"], r["text"]) for r in texts.select("label", "text").collect()], share)


def score(docs: DataFrame, net: Net | float) -> DataFrame:
    """doc_id and score (probability of label 1) of every row."""
    small_batches(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            if isinstance(net, float):
                p = np.full(batch.num_rows, net)
            else:
                parts = [net.score(data, offsets) for _, _, data, offsets in text_parts(batch.column(1), PART_BYTES)]
                p = np.concatenate([*parts, np.zeros(0)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
