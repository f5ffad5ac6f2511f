"""Chat windows: budgets, fill, long system turns and token columns, against a plain greedy choice."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat


def rows(spark, turns):
    return spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, n int")


def by_window(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["conv_id"]].append(r)
    return {c: sorted(ws, key=lambda r: r["window"]) for c, ws in out.items()}


def plain(sizes, system, budget=1024, most=256, back=2):
    """Own turns of each window, chosen one after another; runs of CHUNK places end a window."""
    first, held = (1, sizes[0]) if system else (0, 0)
    windows, room, used = [], -1, 0
    for p in range(first, len(sizes)):
        fresh = p == first or p % chat.CHUNK == 0
        if fresh or used + sizes[p] > room:
            start = max(first, p // chat.CHUNK * chat.CHUNK)
            total = 0
            for q in range(p - 1, max(start, p - back) - 1, -1):
                if total + sizes[q] > most:
                    break
                total += sizes[q]
            if p // chat.CHUNK and p - start < back:
                total = most
            windows.append([])
            room, used = budget - held - total, 0
        windows[-1].append(p)
        used += sizes[p]
    return windows


@pytest.mark.parametrize("system", [0, 40])
def test_windows_equal_a_plain_greedy_choice(spark, system):
    sizes = [([system] if system else []) + [(7 * i * i + 13 * i + c) % 400 + 1 for i in range(600)] for c in range(3)]
    turns = [(c, i, "system" if system and i == 0 else ("user", "assistant")[i % 2], f"t{i}", n) for c, s in enumerate(sizes) for i, n in enumerate(s)]
    found = by_window(chat.windows(rows(spark, turns), tokens="n"))
    for c, s in enumerate(sizes):
        want = plain([n + chat.TURN_TOKENS for n in s], bool(system))
        assert [[t["place"] for t in w["turns"] if not t["repeated"]] for w in found[c]] == [([0] if system and k == 0 else []) + x for k, x in enumerate(want)]
        assert all(w["n_tokens"] <= 1024 or sum(not t["repeated"] for t in w["turns"]) <= 1 + (system > 0) for w in found[c])


def test_windows_are_filled(spark):
    found = by_window(chat.windows(rows(spark, [(1, i, "user", "x", 63) for i in range(400)]), tokens="n"))[1]
    assert all(w["n_tokens"] <= 1024 for w in found) and len(found) <= 34
    assert sum(w["n_tokens"] for w in found) / len(found) > 0.85 * 1024


def test_a_long_system_turn_is_not_repeated(spark):
    turns = [(1, 0, "system", "rules", 3000), *[(1, i, "user", "hi", 300) for i in range(1, 9)], (2, 0, "system", "rules", 300), *[(2, i, "user", "hi", 300) for i in range(1, 9)]]
    found = by_window(chat.windows(rows(spark, turns), tokens="n"))
    long, short = found[1], found[2]
    assert [t["place"] for t in long[0]["turns"]] == [0] and all(w["n_tokens"] <= 1024 for w in long[1:])
    assert all(w["turns"][0]["place"] == 0 and w["n_tokens"] <= 1024 for w in short) and len(short) > 1
    back = chat.read_back(chat.windows(rows(spark, turns), tokens="n")).where("NOT repeated").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["conv_id"]: r["n"] for r in back} == {1: 9, 2: 9}


def test_missing_counts_and_one_turn(spark):
    found = by_window(chat.windows(rows(spark, [(1, 0, "system", "s", None), (None, 0, "assistant", "a", 5), (None, None, None, None, None)]), tokens="n"))
    assert [len(w["turns"]) for w in found[1]] == [1] and sum(len(w["turns"]) for w in found[None]) == 2
