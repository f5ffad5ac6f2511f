"""Hostile input: amounts, vectors, file names, ragged lines, late rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.clean import to_int
from ledgerline.functions.measures import money_sum
from ledgerline.operators.knn import exact_knn, unusable_vectors
from ledgerline.plans import dq_report, gold, silver
from ledgerline.streaming.ingest import header_names, read_new_files
from ledgerline.streaming.runner import Layout, Runner


def test_amounts_out_of_range_are_quarantined_and_sums_survive(spark):
    raw = spark.createDataFrame(
        [("1", "p", "1", "1e20"), ("1", "p", "1", "NaN"), ("1", "p", "1", "0.00004"), ("1", "p", "2.0", "5"), ("1", "p", "3.7", "5"), ("1", "p", "1", None)],
        "order_id string, product_id string, quantity string, sales string",
    )
    base = silver.transactions_base(raw)
    reasons = sorted((r["sales"], r["_dq_reason"]) for r in base.where("NOT _is_valid AND NOT isnan(sales)").collect())
    assert reasons == [(5.0, "Invalid quantity"), (1e20, "Amount out of range")]
    clean = base.where("_is_valid")
    assert clean.count() + base.where("NOT _is_valid").count() == 6
    assert clean.agg(money_sum("sales").alias("s")).first()["s"] == pytest.approx(5.00004, abs=1e-12)
    assert base.agg(money_sum("sales").alias("s")).first()["s"] > 9e19  # no abort even over everything


def test_whole_numbers_written_with_a_point(spark):
    rows = spark.createDataFrame([("2",), ("2.0",), (" 7.00",), ("3.7",), ("abc",), (None,), ("1e2",)], "x string")
    assert [r[0] for r in rows.select(to_int(F.col("x"))).collect()][:6] == [2, 2, 7, None, None, None]


def test_per_rule_reason_end_to_end(spark):
    raw = spark.createDataFrame([(None, None, "0", "5")], "order_id string, product_id string, quantity string, sales string")
    quarantine = silver.transactions_base(raw).where("NOT _is_valid")
    rows = dq_report.failure_report({"transactions": quarantine}, per_rule_reason=True).collect()
    assert {(r["field_name"], r["issue_type"]) for r in rows} == {
        ("_dq_order", "missing order_id"),
        ("_dq_product", "missing product_id"),
        ("_dq_qty", "invalid quantity"),
    }


def test_knn_leaves_out_unusable_vectors_and_repeated_ids(spark):
    nan, inf = float("nan"), float("inf")
    corpus = spark.createDataFrame(
        [(1, [nan, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [1.0, None]), (5, [inf, 0.0]), (6, [0.0, 1.0]), (7, [1.0, 0.0, 0.0]), (8, [])],
        "id int, vec array<double>",
    )
    queries = spark.createDataFrame([(1, [1.0, 0.0])] * 9 + [(2, None), (3, [nan, 1.0])], "q int, qv array<double>")
    found = exact_knn(corpus, queries, 2, corpus_id="id", corpus_vec="vec", query_id="q", query_vec="qv", max_broadcast_bytes=4)
    assert [(r["q"], r["id"], r["distance"]) for r in found.orderBy("rank").collect()] == [(1, 2, 0.0), (1, 6, 2.0)]
    assert tuple(unusable_vectors(corpus, "vec").first()) == (8, 5)


def test_header_names():
    assert header_names('a,,"b, c",A,a') == ["a", "_c1", "b, c", "A3", "a4"]


def test_landed_names_are_literal_and_extra_fields_are_rescued(spark, scratch):
    path = f"{scratch}/customers_[x].csv"
    with open(path, "w") as f:
        f.write("a,b\n1,2,3\n4,5\n6\n")
    rows = {r["a"]: r for r in read_new_files(spark, [path], "csv").collect()}
    assert (rows["1"]["b"], rows["1"]["_rescued_data"]) == ("2", "1,2,3")
    assert (rows["4"]["b"], rows["4"]["_rescued_data"]) == ("5", None)
    assert (rows["6"]["b"], rows["6"]["_rescued_data"]) == (None, "6")


def test_nested_json_stays_json(spark, scratch):
    path = f"{scratch}/returns_1.json"
    with open(path, "w") as f:
        json.dump([{"id": 1, "o": {"k": "v, w"}, "l": ["a", "b"]}], f)
    row = read_new_files(spark, [path], "json").first()
    assert (row["id"], json.loads(row["o"]), json.loads(row["l"])) == ("1", {"k": "v, w"}, ["a", "b"])


def test_late_rows_reach_facts_and_dims(spark, scratch):
    """An order and its line landed in different runs meet; a key seen again in a
    later run keeps one row, the latest, as in batch."""
    landing = f"{scratch}/landing"
    os.makedirs(f"{landing}/Region 1")

    def put(name, text):
        with open(f"{landing}/{name}", "w") as f:
            f.write(text)

    customers = "customer_id,customer_email,customer_name,segment,region\n"
    put("Region 1/customers_1.csv", customers + "c1,a@x,Ann,Consumer,East\n")
    put("Region 1/orders_1.csv", "order_id,customer_id,vendor_id,ship_mode,order_purchase_date\no1,c1,v1,First Class,2024-01-01 00:00:00\n")
    runner = Runner(spark, Layout(f"{scratch}/lake"), checkpoint_root=f"{scratch}/ck")
    runner.run(landing)
    put("Region 1/customers_2.csv", customers + "c1,a@x,Ann,Consumer,West\nlate,b@x,Bob,Consumer,North\n")
    put("transactions_1.csv", "order_id,product_id,discount,sales,profit,quantity\no1,p1,0.1,10,1,2\n")
    runner.run(landing)
    put("transactions_2.csv", "order_id,product_id,discount,sales,profit,quantity\no1,p2,0.1,20,1,1\n")
    runner.run(landing)
    facts = runner.table(runner.layout.gold("fact_transactions"))
    assert sorted(r["product_id"] for r in facts.collect()) == ["p1", "p2"]
    dim = runner.table(runner.layout.gold("dim_customer"))
    assert sorted((r["customer_id"], r["region"]) for r in dim.collect()) == [("c1", "West"), ("late", "North")]
    batch = gold.dim_customer(runner.silver_table("customers"))
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, dim.collect()))
