"""Gold: dimensions, facts and KPI aggregates.

Facts are equi-joins on ``order_id``; the physical strategy is left to AQE
(broadcast when the measured side is small, otherwise sort-merge with
skew-split). Aggregates are partial+final so hot keys are combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import money_sum
from ..operators.dedupe import latest_by_key

DATE_KEY_FORMAT = "yyyyMMdd"
MONTH_FORMAT = "yyyy-MM"
SLOW_MOVING_THRESHOLD = 10
EVENT_TIME = "ingestion_timestamp"
# what Gold reads of each Silver table
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "customer_email", "segment", "region"]
PRODUCT_COLUMNS = ["product_id", "product_name", "categories", "brand", "upc"]
VENDOR_COLUMNS = ["vendor_id", "vendor_name"]
ORDER_COLUMNS = ["order_id", "customer_id", "vendor_id", "region", "order_purchase_date"]
TRANSACTION_COLUMNS = ["order_id", "product_id", "sales", "quantity", "profit"]
RETURN_COLUMNS = ["order_id", "refund_amount", "return_status", "return_date"]


def date_key(c) -> F.Column:
    return F.date_format(c, DATE_KEY_FORMAT).cast("int")


def _dim(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """One row per key: the latest ingested one when Bronze provenance is present."""
    if EVENT_TIME in df.columns:
        return latest_by_key(df.select(*cols, EVENT_TIME), [key], order_by=[EVENT_TIME]).select(*cols)
    return latest_by_key(df.select(*cols), [key])


def dim_customer(customers_clean: DataFrame) -> DataFrame:
    return _dim(customers_clean, CUSTOMER_COLUMNS, "customer_id")


def dim_product(products_clean: DataFrame) -> DataFrame:
    return _dim(products_clean, PRODUCT_COLUMNS, "product_id")


def dim_vendor(vendors_clean: DataFrame) -> DataFrame:
    return _dim(vendors_clean, VENDOR_COLUMNS, "vendor_id")


def dim_date(orders_clean: DataFrame, returns_clean: DataFrame, grain: str = "date") -> DataFrame:
    """One row per calendar date seen on an order or a return.

    ``grain="date"`` (default) casts timestamps to dates and drops NULL, so a
    date_key is unique. ``grain="timestamp"`` keeps the reference's union of
    raw timestamps (repeated keys, a NULL row)."""
    o = orders_clean.select(F.col("order_purchase_date").alias("date"))
    r = returns_clean.select(F.col("return_date").alias("date"))
    if grain == "date":
        dates = o.select(F.col("date").cast("date").alias("date")).unionByName(r).filter(F.col("date").isNotNull())
    elif grain == "timestamp":
        dates = o.unionByName(r.select(F.col("date").cast("timestamp_ntz").alias("date")))
    else:
        raise ValueError(f"unknown grain {grain!r}")
    return dates.dropDuplicates().select(
        "date",
        date_key(F.col("date")).alias("date_key"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
    )


def fact_transactions(orders_clean: DataFrame, transactions_clean: DataFrame) -> DataFrame:
    """Order line grain: region, customer, vendor and date from the order."""
    o = orders_clean.select(*ORDER_COLUMNS)
    t = transactions_clean.select(*TRANSACTION_COLUMNS)
    return o.join(t, "order_id").select(
        "order_id",
        "customer_id",
        "vendor_id",
        "product_id",
        "region",
        F.col("order_purchase_date").alias("date"),
        date_key(F.col("order_purchase_date")).alias("date_key"),
        F.col("sales").alias("sales_amount"),
        "quantity",
        "profit",
    )


def fact_returns(returns_clean: DataFrame, orders_clean: DataFrame, include_region: bool = False) -> DataFrame:
    """Return grain; customer and vendor recovered from the order."""
    r = returns_clean.select(*RETURN_COLUMNS)
    o = orders_clean.select("order_id", "customer_id", "vendor_id", "region")
    cols = [
        "order_id",
        "customer_id",
        "vendor_id",
        "refund_amount",
        "return_status",
        F.col("return_date").alias("date"),
        date_key(F.col("return_date")).alias("date_key"),
    ]
    if include_region:
        cols.append("region")
    return r.join(o, "order_id").select(*cols)


def agg_monthly_revenue(fact_tx: DataFrame) -> DataFrame:
    """Region × month: revenue and distinct orders (NULL month kept)."""
    return fact_tx.groupBy("region", F.date_format("date", MONTH_FORMAT).alias("month")).agg(
        money_sum("sales_amount").alias("total_sales"),
        F.count_distinct("order_id").alias("order_count"),
    )


def agg_customer_returns(fact_ret: DataFrame) -> DataFrame:
    return fact_ret.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("return_count"),
        money_sum("refund_amount").alias("total_refund_amount"),
    )


def agg_vendor_performance(fact_tx: DataFrame, fact_ret: DataFrame) -> DataFrame:
    """Distinct orders and return rows per vendor; vendors without sales drop
    out (left join from sales), rate may exceed 1 (return rows ÷ orders)."""
    orders = fact_tx.groupBy("vendor_id").agg(F.count_distinct("order_id").alias("total_orders"))
    rets = fact_ret.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("total_returns"))
    return vendor_rates(orders, rets)


def vendor_rates(orders: DataFrame, returns: DataFrame) -> DataFrame:
    return (
        orders.join(returns, "vendor_id", "left")
        .fillna(0, subset=["total_returns"])
        .withColumn("return_rate", F.try_divide(F.col("total_returns").cast("double"), F.col("total_orders")))
    )


def agg_slow_moving_products(fact_tx: DataFrame, threshold: int = SLOW_MOVING_THRESHOLD) -> DataFrame:
    """Product × region with fewer than ``threshold`` units sold."""
    return (
        fact_tx.groupBy("product_id", "region")
        .agg(F.sum("quantity").alias("total_quantity_sold"))
        .filter(F.col("total_quantity_sold") < threshold)
    )
