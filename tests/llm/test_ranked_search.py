"""Ranked search against brute force: ties, copies, ids of other types, blocks, books and rounds."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import lexical
from ledgerline.llm.queries import QUERIES


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, k):
    counts = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_words = sum(n > 0 for *_, n in counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, asked in wanted.items():
        scored = []
        for i, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // n_words if n_words else 1
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if c[t])
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "été", "The", "the", "THE"]
    text = lambda m: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=m))
    docs = [(i, text(rng.randrange(40))) for i in range(n)]
    copy = text(20)
    docs += [(1000 + i, copy) for i in range(120)]  # ties, more than any k
    docs += [(5, "w1 w2 w50"), (5, "w1 w2 w50"), (None, "w1 w2 w50"), (None, None), (2000, None), (2001, ""), (2002, "... "), (2003, "w3 " * 5000)]
    rng.shuffle(docs)
    items = [(i, text(rng.randrange(12))) for i in range(30)] + [(3, "w40 w41"), (31, None), (32, "unknown words"), (None, "w1 w7"), (33, copy), (33, copy)]
    return docs, items


@pytest.fixture
def frames(spark):
    def make(docs, items, kind="long"):
        extra = [(i, t, 1, "x") for i, t in docs]
        return spark.createDataFrame(extra, f"doc_id {kind}, text string, n int, terms string").repartition(5), spark.createDataFrame(items, f"item_id {kind}, text string")

    return make


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(frames, seed):
    docs, items = corpus(seed)
    assert rows(lexical.ranked_search(*frames(docs, items), k=10)) == brute_force(docs, items, 10)


def test_books_blocks_and_rounds_change_nothing(frames, monkeypatch):
    docs, items = corpus(3)
    for name, value in (("BOOK_TERMS", 60), ("BLOCK_ITEMS", 4), ("ROUND", 3), ("LEAST", 20)):
        monkeypatch.setattr(lexical, name, value)
    assert rows(lexical.ranked_search(*frames(docs, items), k=7)) == brute_force(docs, items, 7)


def test_ids_as_text(frames):
    docs, items = corpus(4)
    docs, items = ([(None if i is None else f"id{i}", t) for i, t in x] for x in (docs, items))
    want = brute_force([(i, t) for i, t in docs if i is not None], items, 5)  # ties by text order
    assert rows(lexical.ranked_search(*frames([d for d in docs if d[0] is not None], items, "string"), k=5)) == sorted(want, key=str)


def test_empty_tables(frames):
    docs, items = corpus(5, 5)
    assert lexical.ranked_search(*frames([], items)).count() == 0
    assert lexical.ranked_search(*frames(docs, [])).count() == 0
    assert lexical.ranked_search(*frames([(1, None)], [(1, "a")])).count() == 0


def test_query_on_given_tables(spark):
    from conftest import SF_SMALL

    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert rows(QUERIES["op12_ranked_search"](spark, SF_SMALL)) == brute_force(docs, items, 50)


def test_bounds_hold_and_prune():
    """Every node pair's bound is at least its best score; alike documents and items are dropped in batches."""
    rng = np.random.RandomState(1)
    topics, n_docs, n_items, k = 16, 2048, 64, 3
    doc, term, value = [], [], []
    for d in range(n_docs):
        own = rng.choice(20, 8, replace=False) + 20 * (d % topics)
        doc += [d] * 8
        term += own.tolist()
        value += rng.randint(1, 1000, 8).tolist()
    doc, term, value = (np.array(x, np.int64) for x in (doc, term, value))
    item = np.repeat(np.arange(n_items), 5)
    wanted = np.concatenate([rng.choice(20, 5, replace=False) + 20 * (i % topics) for i in range(n_items)])
    weight = rng.randint(1, 50, 20 * topics).astype(np.int64)
    order = np.argsort(doc % topics, kind="stable")  # documents of a topic are neighbours
    place = np.empty(len(doc), np.int64)
    where = np.argsort(np.arange(n_docs) % topics, kind="stable")
    place = np.argsort(where)[doc]
    tree = lexical.ItemTree(item, wanted, weight, n_items)
    levels = [lexical.Nodes(place, term, value, n_docs, len(weight))]
    for i in range(3, 0, -1):
        levels.insert(0, levels[0].merged(lexical.DOC_NODE[i - 1] // lexical.DOC_NODE[i], len(weight)))
    dense_d, dense_i = np.zeros((n_docs, len(weight))), np.zeros((n_items, len(weight)))
    dense_d[place, term], dense_i[item, wanted] = value, weight[wanted]
    scores = dense_d @ dense_i.T
    for depth, (size, group) in enumerate(zip(lexical.DOC_NODE, lexical.ITEM_NODE, strict=True)):
        bounds = tree.bounds(levels[depth], np.arange(levels[depth].n), depth)
        ordered = scores[:, tree.items]
        best = np.maximum.reduceat(np.maximum.reduceat(ordered, np.arange(0, n_docs, size), 0), np.arange(0, n_items, group), 1)
        assert (bounds >= best).all() and (size > 1 or (bounds == best).all())
    best = lexical.Best(np.zeros(n_items, np.int64), k)
    scored = lexical.search(tree, best, levels, pa.array(np.arange(n_docs)))
    for i in range(n_items):
        want = sorted(((-int(s), d) for d, s in enumerate(scores[:, i]) if s > 0))[:k]
        assert [(-s, d) for s, d in zip(best.score[best.item == i].tolist(), best.id.to_numpy()[best.item == i].tolist(), strict=True)] == want
    assert scored < 0.2 * n_docs * n_items
    assert len(order) == len(doc)
