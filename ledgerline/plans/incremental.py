"""Registered queries of the incremental path.

The testbed's raw entities arrive as regional CSV and JSON files in three drops,
with late rows (orders before their customers, lines before and after their orders),
rows delivered again and changed rows of known keys. After each drop the runner drains
what is new through Bronze, Silver and Gold; a query reads one of the tables it left.

The drops are written by Spark from the whole tables, so the work grows with them. Within
one session the queries share the lake of a folder of tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import normalize_columns
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables, stage
from ..sources.testbed import raw_entities
from ..streaming.ingest import IngestSpec, read_bronze, read_bronze_typed
from ..streaming.runner import Layout, Runner
from .lake_catalog import register_tables

# Which keys arrive when.
DROPS = 3
LATE_CUSTOMER = (10, 3)  # key % 10 = 3: in the second drop
CHANGED_CUSTOMER = (7, 1)  # once more, with another address, in the third
CHANGED_PRODUCT = (9, 0)  # once more, with another brand, in the second
CHANGED_VENDOR = (4, 0)  # once more, with another name, in the second
REPEATED_ORDER = 50  # keys divisible by it: delivered again in the third drop
REPEATED_LINE = 40
# orders carry a Weight from the second drop on: whole numbers there, halves in the third

#: Spark writes a folder of part files for every landed "file"
SPECS = (
    IngestSpec("customers", "Region */customers_*.csv/*", "csv"),
    IngestSpec("orders", "Region */orders_*.csv/*", "csv"),
    IngestSpec("transactions", "transactions_*.csv/*", "csv"),
    IngestSpec("products", "products_*.json/*", "json"),
    IngestSpec("returns", "returns_*.json/*", "json"),
    IngestSpec("vendors", "vendors_*.csv/*", "csv"),
)


def _key(name: str) -> Column:
    return F.col(name).try_cast("bigint")


def _is(key: Column, rule: tuple[int, int]) -> Column:
    return F.coalesce(key % rule[0] == rule[1], F.lit(False))


def _again(first: Column, repeat: Column) -> Column:
    """The drops a row arrives in: the first, and the third if it is repeated."""
    return F.when(repeat & (first < DROPS), F.array(first, F.lit(DROPS))).otherwise(F.array(first))


def arrivals(raw, drop: int) -> dict[str, DataFrame]:
    """Raw rows of one drop by landed file name. Rows are chosen by their keys alone, so that
    only those that arrive are turned into text."""
    now = lambda rows, drops: rows.where(F.array_contains(drops, drop))
    one, both = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    c = raw["customers"]
    key = F.coalesce(_key("Customer ID"), _key("cust_id"))
    first = F.when(_is(key, LATE_CUSTOMER), 2).otherwise(1)
    c = now(c, F.when(_is(key, CHANGED_CUSTOMER), F.array(first, F.lit(DROPS))).otherwise(F.array(first)))
    new = lambda name: (F.concat(F.lit("new."), F.col(name)) if drop == DROPS else F.col(name)).alias(name)
    order, line, back = _key("Order ID"), _key("ProductID"), _key("OrderId")
    orders = now(raw["orders"], _again((1 + order % 3).cast("int"), order % REPEATED_ORDER == 0))
    if drop > 1:
        orders = orders.withColumn("Weight", (order % 5 if drop == 2 else order % 5 + 0.5).cast("string"))
    products = now(raw["products"], F.when(_is(_key("ProductID"), CHANGED_PRODUCT), both).otherwise(one))
    vendors = now(raw["vendors"], F.when(_is(_key("VendorID"), CHANGED_VENDOR), both).otherwise(one))
    second = lambda name, text: (F.concat(F.lit(text), F.col(name)) if drop == 2 else F.col(name)).alias(name)
    return {
        "Region 1/customers": c.where(F.col("Customer Name").isNotNull()).select("Customer ID", new("Customer Email"), "Customer Name", "Segment", "Region"),
        "Region 2/customers": c.where(F.col("full_name").isNotNull()).select("cust_id", new("email_address"), "full_name", "Segment", "Region"),
        "Region 1/orders": orders,
        "transactions": now(raw["transactions"], _again((1 + F.floor(order / 3) % 3).cast("int"), F.coalesce(line % REPEATED_LINE == 0, F.lit(False)))),
        "returns": now(raw["returns"], F.array((1 + F.floor(back / 2) % 3).cast("int"))),
        "products": products.select("ProductID", "Product Name", second("Brand", "new "), "Categories", "UPC"),
        "vendors": vendors.select("VendorID", second("Vendor Name", "renamed ")),
    }


def land(raw, landing: str, drop: int) -> None:
    """Writes the files of one drop, compressed and side by side."""

    def write(name: str, rows: DataFrame) -> None:
        if name in ("returns", "products"):
            rows.write.option("compression", "gzip").json(f"{landing}/{name}_{drop}.json")
        else:
            rows.write.option("header", True).option("compression", "gzip").csv(f"{landing}/{name}_{drop}.csv")

    files = arrivals(raw, drop)
    with ThreadPoolExecutor(len(files)) as pool:
        for done in [pool.submit(write, name, rows) for name, rows in files.items()]:
            done.result()


_LAKES: dict[tuple[str, str], Runner] = {}


def lake(spark: SparkSession, sf_dir: str) -> Runner:
    """The lake after three drops; built once in a session for a folder of tables."""
    known = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if known not in _LAKES:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-lake/{uuid.uuid4().hex}"
        runner = Runner(spark, Layout(f"{root}/lake"), checkpoint_root=f"{root}/checkpoints")
        raw = dict(raw_entities(Tables(spark, sf_dir)))
        raw["orders"] = stage(raw["orders"], "raw-orders")  # joined with the lines once, read by every drop
        for drop in range(1, DROPS + 1):
            land(raw, f"{root}/landing", drop)
            runner.run(f"{root}/landing", specs=SPECS)
        _LAKES[known] = runner
    return _LAKES[known]


Query = Callable[[SparkSession, str], DataFrame]


def _gold(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lake(spark, sf_dir).gold_table(name)

    run.__name__ = f"stream_{name}"
    return run


def _bronze(entity: str, columns: list[str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Raw text by normalized header, and the drop and region from the file's path."""
        rows = normalize_columns(read_bronze(spark, lake(spark, sf_dir).layout.bronze, entity))
        path = F.url_decode("source_file")
        region = F.nullif(F.regexp_extract(path, "/(Region [0-9]+)/", 1), F.lit(""))
        return rows.select(*columns, F.regexp_extract(path, f"{entity}_([0-9]+)", 1).cast("int").alias("arrived"), region.alias("landed_in"))

    run.__name__ = f"bronze_{entity}"
    return run


def bronze_orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the types of the schema log: a column new in the second drop, widened in the third."""
    rows = normalize_columns(read_bronze_typed(spark, lake(spark, sf_dir).layout.bronze, "orders"))
    return rows.select("order_id", "customer_id", "vendor_id", "ship_mode", "order_purchase_date", "weight")


def stream_sql_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every Bronze, Silver and Gold table, by SQL over the catalog."""
    database = "ledgerline_lake"
    names = register_tables(lake(spark, sf_dir), database)
    counts = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {database}.{n}" for n in names)
    return spark.sql(counts)


def _silver(entity: str, status: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lake(spark, sf_dir).silver_table(entity, status).drop("source_file", "ingestion_timestamp")

    run.__name__ = f"stream_{status}_{entity}"
    return run


GOLD = (
    "dim_customer",
    "dim_product",
    "dim_vendor",
    "dim_date",
    "fact_transactions",
    "fact_returns",
    "agg_monthly_revenue",
    "agg_customer_returns",
    "agg_vendor_performance",
    "agg_slow_moving_products",
)
BRONZE = {
    "customers": ["customer_id", "customer_email", "customer_name", "cust_id", "email_address", "full_name", "segment", "region"],
    "orders": ["order_id", "customer_id", "vendor_id", "ship_mode", "order_purchase_date"],
    "returns": ["orderid", "amount", "status", "return_date"],
}

QUERIES: dict[str, Query] = {f"stream_{name}": _gold(name) for name in GOLD}
QUERIES |= {f"bronze_{entity}": _bronze(entity, columns) for entity, columns in BRONZE.items()}
QUERIES |= {"bronze_orders_typed": bronze_orders_typed, "stream_sql_tables": stream_sql_tables}
QUERIES |= {f"stream_{status}_orders": _silver("orders", status) for status in ("clean", "quarantine")}


# ---- the same rows in SQL, on top of the batch CTEs ------------------------------------------------

_CTES = f"""
s_customers AS (
  SELECT b.* REPLACE (CASE WHEN d = {DROPS} THEN 'new.' || customer_email ELSE customer_email END AS customer_email), d
  FROM customers_base b,
    unnest(CASE WHEN CAST(customer_id AS BIGINT) % {CHANGED_CUSTOMER[0]} = {CHANGED_CUSTOMER[1]}
      THEN [CASE WHEN CAST(customer_id AS BIGINT) % {LATE_CUSTOMER[0]} = {LATE_CUSTOMER[1]} THEN 2 ELSE 1 END, {DROPS}]
      ELSE [CASE WHEN CAST(customer_id AS BIGINT) % {LATE_CUSTOMER[0]} = {LATE_CUSTOMER[1]} THEN 2 ELSE 1 END] END) u(d)
),
s_known AS (SELECT customer_id, min(d) AS since, max(region) AS region FROM s_customers WHERE _is_valid GROUP BY customer_id),
s_orders_raw AS (
  SELECT o.*, d FROM orders_norm o,
    unnest(CASE WHEN CAST(order_id AS BIGINT) % {REPEATED_ORDER} = 0 AND CAST(order_id AS BIGINT) % 3 < 2
      THEN [1 + CAST(order_id AS BIGINT) % 3, {DROPS}] ELSE [1 + CAST(order_id AS BIGINT) % 3] END) u(d)
),
s_orders_f AS (
  SELECT o.order_id, o.customer_id, o.vendor_id, CASE WHEN k.since <= o.d THEN k.region END AS region,
    CASE WHEN o.ship_mode IN ('1st Class', 'First Class') THEN 'First Class' ELSE o.ship_mode END AS ship_mode,
    coalesce(try_strptime(o.order_purchase_date, '%m/%d/%Y %H:%M'), try_strptime(o.order_purchase_date, '%Y-%m-%d %H:%M')) AS order_purchase_date,
    o.order_id IS NOT NULL AS _dq_order, o.customer_id IS NOT NULL AS _dq_customer, o.vendor_id IS NOT NULL AS _dq_vendor,
    coalesce(k.since <= o.d AND k.region IS NOT NULL, false) AS _dq_region
  FROM s_orders_raw o LEFT JOIN s_known k ON o.customer_id = k.customer_id
),
s_orders AS (
  SELECT *, _dq_order AND _dq_customer AND _dq_vendor AND _dq_region AS _is_valid,
    CASE WHEN NOT _dq_order THEN 'Missing order_id' WHEN NOT _dq_customer THEN 'Missing customer_id'
         WHEN NOT _dq_vendor THEN 'Missing vendor_id' WHEN NOT _dq_region THEN 'Missing region' END AS _dq_reason
  FROM s_orders_f
),
s_orders_clean AS (SELECT * FROM s_orders WHERE _is_valid),
s_products AS (
  SELECT b.* FROM products_base b, unnest(CASE WHEN CAST(product_id AS BIGINT) % {CHANGED_PRODUCT[0]} = {CHANGED_PRODUCT[1]} THEN [1, 2] ELSE [1] END) u(d)
),
s_vendors AS (
  SELECT b.* FROM vendors_base b, unnest(CASE WHEN CAST(vendor_id AS BIGINT) % {CHANGED_VENDOR[0]} = {CHANGED_VENDOR[1]} THEN [1, 2] ELSE [1] END) u(d)
),
s_transactions AS (
  SELECT t.* FROM transactions_base t,
    unnest(CASE WHEN CAST(product_id AS BIGINT) % {REPEATED_LINE} = 0 AND CAST(order_id AS BIGINT) // 3 % 3 < 2 THEN [1, 2] ELSE [1] END) u(d)
),
s_transactions_clean AS (SELECT * FROM s_transactions WHERE _is_valid),
s_fact_transactions AS (
  SELECT o.order_id, o.customer_id, o.vendor_id, t.product_id, o.region, o.order_purchase_date AS date,
    CAST(strftime(o.order_purchase_date, '%Y%m%d') AS INTEGER) AS date_key, t.sales AS sales_amount, t.quantity, t.profit
  FROM s_orders_clean o JOIN s_transactions_clean t ON o.order_id = t.order_id
),
s_fact_returns AS (
  SELECT r.order_id, o.customer_id, o.vendor_id, r.refund_amount, r.return_status, r.return_date AS date,
    CAST(strftime(r.return_date, '%Y%m%d') AS INTEGER) AS date_key
  FROM returns_clean r JOIN s_orders_clean o ON r.order_id = o.order_id
)
"""

_LANDED = "CASE WHEN {} THEN 'Region 1' ELSE 'Region 2' END"

_BODIES: dict[str, str] = {
    "stream_fact_transactions": "SELECT * FROM s_fact_transactions",
    "stream_fact_returns": "SELECT * FROM s_fact_returns",
    "stream_dim_customer": """
        SELECT customer_id, customer_name, customer_email, segment, region FROM s_customers WHERE _is_valid
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY d DESC) = 1""",
    "stream_dim_product": f"""
        SELECT product_id, product_name, categories, upc,
          CASE WHEN CAST(product_id AS BIGINT) % {CHANGED_PRODUCT[0]} = {CHANGED_PRODUCT[1]} THEN 'new ' || brand ELSE brand END AS brand
        FROM products_clean""",
    "stream_dim_vendor": f"""
        SELECT vendor_id, CASE WHEN CAST(vendor_id AS BIGINT) % {CHANGED_VENDOR[0]} = {CHANGED_VENDOR[1]} THEN 'Renamed ' || vendor_name ELSE vendor_name END AS vendor_name
        FROM vendors_clean""",
    "stream_dim_date": """
        SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(date) AS INTEGER) AS year,
               CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day
        FROM (SELECT CAST(order_purchase_date AS DATE) AS date FROM s_orders_clean UNION SELECT return_date FROM returns_clean) x
        WHERE date IS NOT NULL""",
    "stream_agg_monthly_revenue": """
        SELECT region, strftime(date, '%Y-%m') AS month, CAST(sum(CAST(sales_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_sales,
          count(DISTINCT order_id) AS order_count
        FROM s_fact_transactions GROUP BY ALL""",
    "stream_agg_customer_returns": """
        SELECT customer_id, count(*) AS return_count, CAST(sum(CAST(refund_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_refund_amount
        FROM s_fact_returns GROUP BY customer_id""",
    "stream_agg_vendor_performance": """
        SELECT s.vendor_id, s.total_orders, coalesce(r.total_returns, 0) AS total_returns, coalesce(r.total_returns, 0) * 1.0 / s.total_orders AS return_rate
        FROM (SELECT vendor_id, count(DISTINCT order_id) AS total_orders FROM s_fact_transactions GROUP BY vendor_id) s
        LEFT JOIN (SELECT vendor_id, count(*) AS total_returns FROM s_fact_returns GROUP BY vendor_id) r ON s.vendor_id = r.vendor_id""",
    "stream_agg_slow_moving_products": """
        SELECT product_id, region, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold
        FROM s_fact_transactions GROUP BY product_id, region HAVING sum(quantity) < 10""",
    "bronze_orders_typed": """
        SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id, CAST(vendor_id AS BIGINT) AS vendor_id, ship_mode, order_purchase_date,
          CASE d WHEN 2 THEN CAST(CAST(order_id AS BIGINT) % 5 AS DOUBLE) WHEN 3 THEN CAST(order_id AS BIGINT) % 5 + CAST(0.5 AS DOUBLE) END AS weight
        FROM s_orders_raw""",
    "stream_sql_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM ({rows}) x"
        for name, rows in (
            ("bronze_customers", "SELECT 1 FROM s_customers"),
            ("bronze_orders", "SELECT 1 FROM s_orders_raw"),
            ("bronze_transactions", "SELECT 1 FROM s_transactions"),
            ("bronze_returns", "SELECT 1 FROM returns_raw"),
            ("bronze_products", "SELECT 1 FROM s_products"),
            ("bronze_vendors", "SELECT 1 FROM s_vendors"),
            ("silver_customers", "SELECT 1 FROM s_customers WHERE _is_valid"),
            ("silver_orders", "SELECT 1 FROM s_orders WHERE _is_valid"),
            ("silver_transactions", "SELECT 1 FROM s_transactions_clean"),
            ("silver_returns", "SELECT 1 FROM returns_clean"),
            ("silver_products", "SELECT 1 FROM s_products WHERE _is_valid"),
            ("silver_vendors", "SELECT 1 FROM s_vendors WHERE _is_valid"),
            ("quarantine_customers", "SELECT 1 FROM s_customers WHERE NOT _is_valid"),
            ("quarantine_orders", "SELECT 1 FROM s_orders WHERE NOT _is_valid"),
            ("quarantine_transactions", "SELECT 1 FROM s_transactions WHERE NOT _is_valid"),
            ("quarantine_returns", "SELECT 1 FROM returns_base WHERE NOT _is_valid"),
            ("quarantine_products", "SELECT 1 FROM s_products WHERE NOT _is_valid"),
            ("quarantine_vendors", "SELECT 1 FROM s_vendors WHERE NOT _is_valid"),
            ("dim_customer", "SELECT DISTINCT customer_id FROM s_customers WHERE _is_valid"),
            ("dim_product", "SELECT 1 FROM products_clean"),
            ("dim_vendor", "SELECT 1 FROM vendors_clean"),
            ("dim_date", "SELECT CAST(order_purchase_date AS DATE) AS date FROM s_orders_clean WHERE order_purchase_date IS NOT NULL UNION SELECT return_date FROM returns_clean WHERE return_date IS NOT NULL"),
            ("fact_transactions", "SELECT 1 FROM s_fact_transactions"),
            ("fact_returns", "SELECT 1 FROM s_fact_returns"),
            ("agg_monthly_revenue", "SELECT DISTINCT region, strftime(date, '%Y-%m') FROM s_fact_transactions"),
            ("agg_customer_returns", "SELECT DISTINCT customer_id FROM s_fact_returns"),
            ("agg_vendor_performance", "SELECT DISTINCT vendor_id FROM s_fact_transactions"),
            ("agg_slow_moving_products", "SELECT product_id FROM s_fact_transactions GROUP BY product_id, region HAVING sum(quantity) < 10"),
        )
    ),
    "stream_clean_orders": "SELECT * FROM s_orders WHERE _is_valid",
    "stream_quarantine_orders": "SELECT * FROM s_orders WHERE NOT _is_valid",
    "bronze_orders": "SELECT order_id, customer_id, vendor_id, ship_mode, order_purchase_date, CAST(d AS INTEGER) AS arrived, 'Region 1' AS landed_in FROM s_orders_raw",
    "bronze_returns": """
        SELECT order_id AS orderid, CASE WHEN refund_amount IS NOT NULL THEN refund_prefix || CAST(refund_amount AS VARCHAR) END AS amount, status,
          date_text AS return_date, CAST(1 + CAST(order_id AS BIGINT) // 2 % 3 AS INTEGER) AS arrived, CAST(NULL AS VARCHAR) AS landed_in
        FROM returns_raw""",
    "bronze_customers": f"""
        SELECT n.customer_id, CASE WHEN d = {DROPS} THEN 'new.' || n.customer_email ELSE n.customer_email END AS customer_email, n.customer_name, n.cust_id,
          CASE WHEN d = {DROPS} THEN 'new.' || n.email_address ELSE n.email_address END AS email_address, n.full_name, n.segment, n.region,
          CAST(d AS INTEGER) AS arrived, {_LANDED.format("n.customer_name IS NOT NULL")} AS landed_in
        FROM customers_norm n,
          unnest(CASE WHEN CAST(coalesce(customer_id, cust_id) AS BIGINT) % {CHANGED_CUSTOMER[0]} = {CHANGED_CUSTOMER[1]}
            THEN [CASE WHEN CAST(coalesce(customer_id, cust_id) AS BIGINT) % {LATE_CUSTOMER[0]} = {LATE_CUSTOMER[1]} THEN 2 ELSE 1 END, {DROPS}]
            ELSE [CASE WHEN CAST(coalesce(customer_id, cust_id) AS BIGINT) % {LATE_CUSTOMER[0]} = {LATE_CUSTOMER[1]} THEN 2 ELSE 1 END] END) u(d)""",
}


def oracle_sql(batch_ctes: str) -> dict[str, str]:
    return {name: f"WITH {batch_ctes.strip()},\n{_CTES.strip()}\n{body.strip()}" for name, body in _BODIES.items()}
