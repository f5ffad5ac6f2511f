"""Hard negatives against brute force; segment bounds; defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hardneg
from ledgerline.llm.queries import QUERIES

SCHEMA = "id long, label long, vector array<double>, shard int, block int, windows string"


def brute_force(rows, positives=5, negatives=10, low=30, high=90, every=10):
    known = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None:
            known[i] = min(known.get(i, (label, v)), (label, v))
    width = max((len(v) for _, v in known.values()), default=0)
    whole = {i: (label, [int(x) for x in v] + [0] * (width - len(v))) for i, (label, v) in known.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=True)) for i, (_, w) in whole.items() if i != a}
        best = sorted((-s, i) for i, s in score.items() if whole[i][0] == label)[:positives]
        for s, p in best:
            fits = sorted((-t, i) for i, t in score.items() if whole[i][0] != label and low * -s <= 100 * t <= high * -s)[:negatives]
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i) in enumerate(fits)]
    return sorted(out)


def run(spark, rows, every=10):
    df = spark.createDataFrame([(*r, 1, 2, "w") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hardneg.hard_negatives(df, F.col("id") % every == 0).collect())


def vectors(seed, n=400, width=7, labels=4):
    rng = np.random.RandomState(seed)
    centres = rng.normal(0, 60, (labels, width))
    out = []
    for i in range(n):
        label = int(rng.randint(labels)) if i % 3 else 0  # a hot label
        out.append((i, label, np.floor(centres[label] * 0.5 + rng.normal(0, 40, width) + 30).tolist()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = vectors(seed)
    assert run(spark, rows) == brute_force(rows)


def test_copies_ties_and_missing(spark):
    rows = vectors(3, 120)
    rows += [(1000 + i, i % 2, rows[10][2]) for i in range(60)]  # copies under both labels
    rows += [(2000, None, rows[0][2]), (None, 1, rows[0][2]), (2001, 1, None), (7, 2, rows[3][2]), (7, 0, rows[4][2]), (2010, 9, rows[5][2]), (2020, 1, [5.0, -3.0])]
    assert run(spark, rows) == brute_force(rows)
    assert run(spark, [(0, 1, [1.0]), (1, 1, [2.0])]) == [] and run(spark, [(0, 1, [1.0])]) == [] and run(spark, []) == []


def test_shards_and_blocks_change_nothing(spark, monkeypatch):
    rows = vectors(4)
    want = brute_force(rows)
    monkeypatch.setattr(hardneg, "SHARD_ROWS", (40, 60))
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 7)
    assert run(spark, rows) == want


def test_components_beyond_double_precision(spark):
    rows = [(0, 1, [2.0**60, 1.0]), (1, 1, [2.0, 7.0]), (2, 2, [1.0, 3.0]), (3, 2, [1.0, 2.0]), (4, 2, [0.0, 9.0])]
    assert run(spark, rows) == brute_force(rows)


def test_bounds_hold():
    rng = np.random.RandomState(5)
    x, y = np.floor(rng.normal(0, 50, (40, 24))), np.floor(rng.normal(10, 50, (300, 24)))
    a, b, exact = hardneg.Summary(x), hardneg.Summary(y), x @ y.T
    last = None
    for level in range(len(hardneg.LEVELS)):
        middle, radius = hardneg.dense_bounds(a, b, level)
        assert (np.abs(exact - middle) <= radius).all()
        i, j = np.nonzero(exact > exact.mean())
        m, r = hardneg.pair_bounds(a, b, level, i, j)
        assert np.allclose(m, middle[i, j]) and np.allclose(r, radius[i, j])
        assert last is None or radius.mean() < last
        last = radius.mean()


def test_query_leaves_out_unusable_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(i, int(i % 3), [0.1 * (i % 7) + 0.2, 0.3, -0.1 * (i % 5)]) for i in range(210)]
    bad = [(300, 1, [nan, 0.1, 0.2]), (400, 1, [inf, 0.1, 0.2]), (500, 1, [None, 0.1, 0.2]), (600, 1, None), (700, None, [0.1, 0.2, 0.3])]
    spark.createDataFrame(rows + bad, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = brute_force([(i, (label + 1) % 10 if i % 7 == 0 else label, [float(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, label, v in rows], every=100)
    assert sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, str(tmp_path)).collect()) == want
