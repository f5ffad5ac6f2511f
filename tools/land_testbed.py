"""Write the testbed's raw entities as landing files, the way regional
extracts arrive: two customer files with different headers, orders and
transactions CSV, vendors CSV, products and returns as multi-line JSON.
Test / bench scaffolding only (files are written through pandas)."""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import Tables
from ledgerline.sources.testbed import raw_entities


def _csv(df, path):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    df.toPandas().to_csv(path, index=False)


def _json(df, path):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump([{k: v for k, v in r.asDict().items() if v is not None} for r in df.toLocalIterator()], f)


def land_testbed(spark: SparkSession, sf_dir: str, landing: str) -> int:
    """Returns the number of raw rows landed."""
    raw = raw_entities(Tables(spark, sf_dir))
    c = raw["customers"]
    parts = {
        f"{landing}/Region 1/customers_1.csv": c.filter(F.col("Customer Name").isNotNull()).select(
            "Customer ID", "Customer Email", "Customer Name", "Segment", "Region"
        ),
        f"{landing}/Region 2/customers_2.csv": c.filter(F.col("full_name").isNotNull()).select(
            "cust_id", "email_address", "full_name", "Segment", "Region"
        ),
        f"{landing}/Region 1/orders_1.csv": raw["orders"],
        f"{landing}/transactions_1.csv": raw["transactions"],
        f"{landing}/vendors.csv": raw["vendors"],
    }
    n = 0
    for path, df in parts.items():
        _csv(df, path)
        n += df.count()
    for path, df in ((f"{landing}/products.json", raw["products"]), (f"{landing}/returns_1.json", raw["returns"])):
        _json(df, path)
        n += df.count()
    return n
