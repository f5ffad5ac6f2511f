"""Benchmark rows without an id contaminate documents like any other."""

import corpus_pipeline
import pytest

from ledgerline.llm import decontaminate
from ledgerline.llm.queries import QUERIES

OTHER = " ".join(f"known{chr(97 + i)}" for i in range(14))
NAMELESS = " ".join(f"secret{chr(97 + i)}" for i in range(14))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("items"))
    docs = [(1, f"a {NAMELESS} b"), (2, f"c {OTHER} d"), (3, "none of them"), (4, f"{NAMELESS} {OTHER}")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, OTHER), (None, NAMELESS), (None, NAMELESS), (None, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_query(spark, tables):
    rows = {r["doc_id"]: r for r in QUERIES["op7_decontaminate"](spark, tables).collect()}
    assert {i: (r["n_hit"], r["n_items"], r["contaminated"], r["n_near_items"]) for i, r in rows.items()} == {1: (14, 0, True, 0), 2: (14, 1, True, 1), 3: (0, 0, False, 0), 4: (28, 1, True, 1)}


def test_blocks_of_items(spark, tables):
    docs, items = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "benchmark"))
    one, many = ({r["doc_id"]: (r["hits"], r["item_ids"]) for r in decontaminate.decontaminate(docs, items, max_test_words=n).collect()} for n in (200_000, 8))
    assert one == many and one[1][1] == []


def test_pipeline_stage(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert [r["doc_id"] for r in corpus_pipeline.benchmark_decontamination(spark, docs, tables).collect()] == [3]
