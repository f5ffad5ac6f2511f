"""Typed, persisted schemas of Bronze; heads of many files; literal names of JSON documents."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.streaming.ingest import IngestSpec, head_lines, ingest, read_bronze, read_bronze_typed, read_new_files
from ledgerline.streaming.schema_log import SchemaLog, infer, widen


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.mark.parametrize(
    ("a", "b", "out"),
    [("void", "date", "date"), ("bigint", "double", "double"), ("boolean", "bigint", "string"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "double", "string"), ("string", "void", "string"), ("bigint", "bigint", "bigint")],
)
def test_types_widen(a, b, out):
    assert widen(a, b) == widen(b, a) == out


def test_inference(spark):
    rows = [("1", "1.5", "true", "2024-01-02", "2024-01-02 03:04", "007", None, "x", "9" * 30, "2024-13-01"), ("-20", "3", "FALSE", "2024-02-29", "2024-01-03", "8", None, "1", "1", None)]
    df = spark.createDataFrame(rows, ", ".join(f"`c {i}` string" for i in range(10)))
    assert list(infer(df).values()) == ["bigint", "double", "boolean", "date", "timestamp_ntz", "string", "void", "string", "double", "string"]


def test_new_and_widened_columns_over_two_drops(spark, scratch):
    landing, bronze, spec = f"{scratch}/landing", f"{scratch}/bronze", IngestSpec("orders", "orders_*.csv", "csv")
    put(f"{landing}/orders_1.csv", "id,amount,day\n1,5,2024-01-01\n2,6,\n")
    ingest(spark, landing, bronze, spec, f"{scratch}/ck")
    assert SchemaLog(spark, bronze, "orders").types == {"id": "bigint", "amount": "bigint", "day": "date", "_rescued_data": "void"}
    put(f"{landing}/orders_2.csv", "id,amount,day,flag\n3,7.25,2024-01-02 10:00,true\n")
    ingest(spark, landing, bronze, spec, f"{scratch}/ck")
    log = SchemaLog(spark, bronze, "orders")
    assert log.version == 1 and (log.types["amount"], log.types["day"], log.types["flag"]) == ("double", "timestamp_ntz", "boolean")
    ingest(spark, landing, bronze, spec, f"{scratch}/ck")
    assert SchemaLog(spark, bronze, "orders").version == 1  # nothing new, no new version
    typed = {r["id"]: (r["amount"], str(r["day"]), r["flag"]) for r in read_bronze_typed(spark, bronze, "orders").collect()}
    assert typed == {1: (5.0, "2024-01-01 00:00:00", None), 2: (6.0, "None", None), 3: (7.25, "2024-01-02 10:00:00", True)}
    assert sorted(r["amount"] for r in read_bronze(spark, bronze, "orders").collect()) == ["5", "6", "7.25"]  # raw text stays


def test_heads_of_many_files_by_one_job(spark, scratch):
    paths = [f"{scratch}/heads/f_{i}.csv" for i in range(150)]
    for i, p in enumerate(paths):
        put(p, f"head {i}\n" + "row\n" * 500)
    put(f"{scratch}/heads/none.csv", "")
    spark.sparkContext.setJobGroup("heads", "heads")
    found = head_lines(spark, [*paths, f"{scratch}/heads/none.csv"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("heads")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {p: f"head {i}" for i, p in enumerate(paths)} | {f"{scratch}/heads/none.csv": None}
    assert len(jobs) <= 2  # Spark lists many paths by a job of its own, however many they are


def test_head_of_a_large_file_is_read_in_pieces(spark, scratch):
    """A long file is no single task's work, and its later pieces add no line."""
    put(f"{scratch}/long/a.csv", "id,text\n" + "".join(f"{i},some text\n" for i in range(60_000)))
    put(f"{scratch}/long/b.csv", "other\n1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    spark.sparkContext.setJobGroup("long", "long")
    try:
        found = head_lines(spark, [f"{scratch}/long/a.csv", f"{scratch}/long/b.csv"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("long") for s in tracker.getJobInfo(j).stageIds]
    assert found == {f"{scratch}/long/a.csv": "id,text", f"{scratch}/long/b.csv": "other"}
    assert max(tasks) > 8


def test_json_documents_with_any_name(spark, scratch):
    path = f"{scratch}/a[b]{{c}}*?%41 d.json"
    put(path, json.dumps([{"id": 1, "Id": "x", "o": {"k": [1, 2]}, "n": 6.40e11}, {"id": None, "new": True}, 7], indent=1))
    rows = read_new_files(spark, [path], "json").orderBy(F.desc_nulls_last("Id")).collect()  # keys that differ in case: the second by its place
    assert len(rows) == 3 and (rows[0]["Id"], rows[0]["id1"]) == ("x", "1") and json.loads(rows[0]["o"]) == {"k": [1, 2]}
    assert {r["new"] for r in rows} == {None, "true"} and "7" in {r["_rescued_data"] for r in rows}
    put(f"{scratch}/one.json", '\n {"a": 1}\n')
    assert [r["a"] for r in read_new_files(spark, [f"{scratch}/one.json"], "json").collect()] == ["1"]
