"""Ingest + availableNow runner: headers bind by name, reruns add nothing,
new columns appear, and streaming results equal the batch plan."""

import json
import os

from pyspark.sql import functions as F

from ledgerline.plans import gold, silver
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.streaming.ingest import DEFAULT_SPECS, ingest, read_bronze
from ledgerline.streaming.runner import Layout, Runner


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def land(root):
    """Dirty raw files in the shapes FIXTURES.md lists."""
    _write(
        f"{root}/Region 1/customers_1.csv",
        "Customer ID,email,Segment,Region,Customer Name\n1,a@x.com,CONS,East,Ann\n2,,Corporate,East,Bob\n3,c@x.com,Other,East,Cy\n",
    )
    _write(
        f"{root}/Region 2/customers_2.csv",
        "email_address,cust_id,segment,region,full_name\nd@x.com,4,Home Office,West,Di\ne@x.com,5,,West,Ed\n",
    )
    _write(
        f"{root}/Region 1/orders_1.csv",
        "order_id,customer_id,vendor_id,ship_mode,order_purchase_date\n"
        "10,1,V1,1st Class,01/02/2024 03:04\n11,4,V1,First Class,2024-01-02 03:04\n12,99,V2,Second Class,2024-01-02\n"
        "13,1,,Second Class,junk\n,4,V2,,\n",
    )
    _write(
        f"{root}/transactions_1.csv",
        "Order_ID,ProductID,sales,quantity,discount,profit\n10,P1,100.5,3,40%,10\n10,P2,50,0,0.4,5\n11,P1,20,,abc,1\n11,P2,30,3.7,5%,2\n11,P3,40,2,0.1,3\n",
    )
    _write(
        f"{root}/products.json",
        json.dumps(
            [
                {"product_id": "P1", "product_name": "Widget", "brand": "B", "categories": "Tools", "upc": 6.40e11},
                {"ProductID": "P2", "product_name": "Gizmo", "upc": "123456789012"},
                {"product_name": "Orphan", "upc": None},
            ]
        ),
    )
    _write(
        f"{root}/returns_1.json",
        json.dumps(
            [
                {"order_id": "10", "refund_amount": "$5", "return_status": "apprvd", "date_of_return": "2024-01-05"},
                {"OrderId": "11", "amount": "5", "status": "REJECTED", "return_date": "01/06/2024"},
                {"order_id": "11", "refund_amount": "$1,234.50", "return_status": "PENDG", "date_of_return": "13/40/2024"},
            ]
        ),
    )
    _write(f"{root}/vendors.csv", "VendorID,vendor_name\nV1,ACME-corp o'neil\nV2,globex\n")


def test_ingest_headers_by_name_and_rerun(spark, scratch):
    landing, bronze, ck = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ck"
    land(landing)
    spec = DEFAULT_SPECS[0]
    ingest(spark, landing, bronze, spec, ck)
    df = read_bronze(spark, bronze, "customers")
    assert df.count() == 5
    # region 2's cust_id column is read by name, not by position
    row = df.filter(F.col("cust_id") == "4").collect()[0]
    assert row["email_address"] == "d@x.com" and row["source_file"].endswith("customers_2.csv")
    # rerun with no new files adds nothing
    ingest(spark, landing, bronze, spec, ck)
    assert read_bronze(spark, bronze, "customers").count() == 5
    # a new file with an extra column is picked up with its own header
    _write(f"{landing}/Region 3/customers_3.csv", "customer_id,customer_email,segment,region,loyalty\n6,f@x.com,Consumer,North,gold\n")
    ingest(spark, landing, bronze, spec, ck)
    df = read_bronze(spark, bronze, "customers")
    assert df.count() == 6 and "loyalty" in df.columns
    assert df.filter(F.col("loyalty") == "gold").count() == 1


def _batch_lakehouse(spark, bronze):
    raw = {e: read_bronze(spark, bronze, e).drop("source_file", "ingestion_timestamp") for e in silver.ENTITIES}
    return Lakehouse(raw)


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_streaming_equals_batch(spark, scratch):
    landing = f"{scratch}/landing"
    land(landing)
    results = {}
    for mode, max_files in (("one", 1000), ("many", 1)):
        layout = Layout(f"{scratch}/{mode}")
        r = Runner(spark, layout, checkpoint_root=f"{scratch}/ck_{mode}")
        r.run(landing, max_files=max_files)
        r.run(landing, max_files=max_files)  # rerun: nothing new
        results[mode] = (r, layout)
    lh = _batch_lakehouse(spark, results["one"][1].bronze)
    cols_ft = ["order_id", "customer_id", "vendor_id", "product_id", "region", "date_key", "sales_amount", "quantity"]
    for mode, (r, layout) in results.items():
        ft = r.table(layout.gold("fact_transactions"))
        assert _rows(ft, cols_ft) == _rows(lh.fact_transactions, cols_ft), mode
        fr = r.table(layout.gold("fact_returns"))
        assert _rows(fr, ["order_id", "refund_amount", "return_status"]) == _rows(lh.fact_returns, ["order_id", "refund_amount", "return_status"])
        for e in silver.ENTITIES:
            s_clean = r.silver_table(e, "clean").count()
            s_q = r.silver_table(e, "quarantine").count()
            assert (s_clean, s_q) == (lh.clean(e).count(), lh.quarantine(e).count()), (mode, e)
        dc = r.table(layout.gold("dim_customer"))
        assert dc.count() == dc.select("customer_id").distinct().count()
        assert r.table(layout.gold("agg_monthly_revenue")).count() == lh.agg_monthly_revenue.count()
    # expectations from the fixture
    ft = results["one"][0].table(results["one"][1].gold("fact_transactions"))
    # orders 10 (customer 1, East) and 11 (customer 4, West) are clean; lines with qty 3, 2 survive
    assert _rows(ft, ["order_id", "product_id", "region"]) == [("10", "P1", "East"), ("11", "P3", "West")]
    oq = results["one"][0].silver_table("orders", "quarantine")
    reasons = dict(_rows(oq, ["order_id", "_dq_reason"]))
    assert reasons == {"12": "Missing region", "13": "Missing vendor_id", None: "Missing order_id"}


def test_streaming_dedupe_with_watermark(spark, scratch):
    """Table stream over the driver's events: dedupe within a watermark keeps
    one row per key, the same as the batch dedupe (T6)."""
    from ledgerline.operators.dedupe import latest_by_key

    src = f"{scratch}/events"
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.unionByName(ev).write.parquet(src)  # every event twice
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = (
        latest_by_key(stream, ["event_id"], watermark=("ts", "3650 days"))
        .writeStream.format("memory").queryName("dedup_events").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = spark.table("dedup_events")
    assert got.count() == ev.select("event_id").distinct().count()


def test_runner_command_line(spark, scratch):
    from ledgerline.streaming import runner

    landing = f"{scratch}/landing"
    land(landing)
    runner.main([landing, f"{scratch}/cli"])
    assert spark.read.parquet(f"{scratch}/cli/gold/fact_transactions").count() == 2


def test_json_lines_and_arrays_both_ingest(spark, scratch):
    """Returns landed as one JSON array file and one JSON Lines file."""
    from ledgerline.streaming.ingest import IngestSpec, is_json_lines

    landing, bronze = f"{scratch}/landing", f"{scratch}/bronze"
    _write(f"{landing}/returns_1.json", json.dumps([{"order_id": "1", "amount": "5"}, {"order_id": "2", "amount": "6"}], indent=2))
    _write(f"{landing}/returns_2.json", "\n".join(json.dumps({"order_id": str(i), "amount": "7", "status": "PENDG"}) for i in range(3, 8)) + "\n")
    ingest(spark, landing, bronze, IngestSpec("returns", "returns_*.json", "json"), f"{scratch}/ck")
    df = read_bronze(spark, bronze, "returns")
    assert df.count() == 7 and sorted(r.order_id for r in df.collect()) == [str(i) for i in range(1, 8)]
    assert is_json_lines('{"a": 1}') and not is_json_lines("[") and not is_json_lines("{")


def test_feeds_arriving_over_runs(spark, scratch):
    """First run: only customers and orders have landed — what can be built is
    built, the rest waits. Second run: the other feeds arrive, every table
    appears, and orders are not processed twice."""
    full, landing = f"{scratch}/full", f"{scratch}/landing"
    land(full)
    import shutil

    for rel in ("Region 1/customers_1.csv", "Region 2/customers_2.csv", "Region 1/orders_1.csv"):
        os.makedirs(os.path.dirname(f"{landing}/{rel}"), exist_ok=True)
        shutil.copy(f"{full}/{rel}", f"{landing}/{rel}")
    layout = Layout(f"{scratch}/lake")
    r = Runner(spark, layout, checkpoint_root=f"{scratch}/ck")
    r.run(landing)
    assert r.exists(layout.gold("dim_customer")) and not r.exists(layout.gold("fact_transactions"))
    for rel in ("transactions_1.csv", "products.json", "returns_1.json", "vendors.csv"):
        shutil.copy(f"{full}/{rel}", f"{landing}/{rel}")
    r.run(landing)
    assert r.table(layout.gold("fact_transactions")).count() == 2
    assert r.silver_table("orders", "clean").count() + r.silver_table("orders", "quarantine").count() == 5
    assert r.exists(layout.gold("agg_monthly_revenue"))
