"""Connected components: the right ones, in few rounds, and small copies in few tasks."""

import random

import pytest

from ledgerline.llm import common, components, minhash


@pytest.fixture()
def many_partitions(spark):
    """Far more shuffle partitions than small tables need, and none put together."""
    conf = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture()
def copies(monkeypatch):
    """(label, files) of each staged copy."""
    made = []

    def staged(df, label, *most):
        out = common.staged(df, label, *most)
        made.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(components, "staged", staged)
    monkeypatch.setattr(minhash, "staged", staged)
    return made


def plain(edges):
    of = {}
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        one, two = of.get(a, {a}), of.get(b, {b})
        if one is not two:
            one = one | two
            for x in one:
                of[x] = one
    return {x: min(group) for x, group in of.items()}


def graph(kind):
    rng = random.Random(5)
    if kind == "path":
        ids = rng.sample(range(-500, 500), 60)
        return list(zip(ids, ids[1:], strict=False))
    if kind == "hot":  # a hot node that is not the smallest, with chains behind it
        return [(7000, i) for i in range(1, 400)] + [(i, i + 10_000) for i in range(1, 400, 3)] + [(20_000, 20_001)]
    if kind == "random":
        return [(rng.randrange(900), rng.randrange(900)) for _ in range(500)]
    return [(None, 1), (2, 2), (3, None)]


@pytest.mark.parametrize("kind", ["path", "hot", "random", "none"])
def test_components_equal_plain_ones(spark, kind):
    edges = graph(kind)
    edges += [(b, a) for a, b in edges[:20]] + edges[:10]
    rows = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["root"] for r in rows} == plain(edges)


def test_stars_need_no_round(spark, copies):
    stars = [(i % 5, i) for i in range(5, 200)]
    found = components.connected(spark.createDataFrame(stars, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == plain(stars)
    assert [label for label, _ in copies] == ["edges", "large-star"]


def test_small_copies_are_not_written_by_a_task_for_each_partition(many_partitions, copies):
    spark = many_partitions
    edges = graph("hot")
    found = components.connected(spark.createDataFrame(edges, "a long, b long").repartition(3), most=len(edges))
    assert {r["node"]: r["root"] for r in found.collect()} == plain(edges)
    assert max(files for _, files in copies) <= spark.sparkContext.defaultParallelism


def test_near_duplicates_write_small_copies_in_few_tasks(many_partitions, copies):
    spark, rng = many_partitions, random.Random(3)
    docs, want = [], {}
    for family in range(60):
        text = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for copy in range(4):
            want[len(docs)] = len(docs) - copy
            docs.append((len(docs), " ".join([*text, *[f"end{family}x{i}" for i in range(copy)]])))
    found = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shingle=3, percent=85)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == want
    dealt = {"sketches", "likely-forest", "linked-forest"}  # these hold the work on texts and signatures
    assert {label for label, _ in copies} >= {"shared-bands", "nodes", "cluster-nodes", "component-nodes", "node-components"}
    assert max(files for label, files in copies if label not in dealt) <= spark.sparkContext.defaultParallelism


def test_a_large_copy_keeps_its_tasks(many_partitions):
    spark = many_partitions
    df = spark.range(5000).repartition(61, "id")
    assert len(common.staged(df, "test", 61 * common.STAGED_BYTES).inputFiles()) == 61
