"""Near-duplicate pairs exactly at the threshold: each is linked, whatever its size."""

import random

import numpy as np
import pytest

from ledgerline.llm import minhash


def pairs_at(words: int, more: int, n: int, seed: int) -> list[tuple[int, str]]:
    """Texts 2i and 2i+1: ``words`` words, and the same with ``more`` behind them."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    rows = []
    for i in range(n):
        text = [word() for _ in range(words + more)]
        rows += [(2 * i, " ".join(text[:words])), (2 * i + 1, " ".join(text))]
    return rows


# shingle size, threshold, words in common, further words: 4 of 5, 8 of 10, 16 of 20; 6 of 7, 17 of 20
AT = [(5, 80, 8, 1), (5, 80, 12, 2), (5, 80, 20, 4), (3, 85, 8, 1), (3, 85, 19, 3)]


@pytest.mark.parametrize("shingle, percent, words, more", AT)
def test_pairs_at_the_threshold_are_linked(spark, shingle, percent, words, more):
    rows = pairs_at(words, more, 2000, words)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle, percent)
    alone = found.where("component_id <> doc_id - doc_id % 2").count()
    assert alone == 0


def test_estimate_of_larger_sets_keeps_pairs_at_the_threshold():
    scheme, rng, shared, more = minhash.Scheme(5, 80), np.random.RandomState(8), 64, 16
    lost = 0
    for _ in range(10):
        sets = []
        for _ in range(500):
            s = rng.randint(0, 2**62, shared + more).astype(np.uint64) * np.uint64(4)
            sets += [s[:shared], s]
        signature = minhash.packed(minhash.minima(sets, scheme))
        lost += sum(minhash.similarity(signature[i], signature[i + 1 : i + 2], scheme.hashes)[0] < scheme.estimate_from for i in range(0, 1000, 2))
    assert lost == 0


def test_blocks_of_any_size_give_the_same_components(spark):
    """Large clusters, dealt out as pairs of blocks of sketches and of texts, against plain pairs."""
    import random
    from collections import defaultdict

    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for family in range(3):
        base = [rng.choice(vocabulary) for _ in range(80)]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 6, 12])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(words)))
    docs += [(1000 + i, " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(40)]
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(len(t.split()) - 2)} for i, t in docs}
    near = defaultdict(set)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a != b and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                near[a].add(b)
    want = {}
    for i in sorted(sets):
        if i not in want:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in want:
                    want[j] = i
                    todo += near[j]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for block, sketch_block in ((256, 4096), (4, 4096), (256, 8), (3, 5)):
        found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, shingle=3, percent=85, block=block, sketch_block=sketch_block).collect()}
        assert found == want, (block, sketch_block)
