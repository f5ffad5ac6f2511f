"""Raw (Bronze-shaped) retail entities derived from the driver's parquet tables.

The driver tables are clean, so the dirt Silver must handle is injected by
fixed rules on keys (a rule changes a value to NULL or junk; no row is ever
filtered out). Values are text, as a CSV-based Bronze table holds them, and
headers vary in case, spacing and spelling like the regional files do.

Every frame is a whole-table projection/join of the driver tables, so its
work grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables

# The dirt rules (key % modulus → injected defect).
NULL_CUSTOMER_ID_MOD = 97
NULL_EMAIL_MOD = 11
NULL_SEGMENT_MOD = 13
JUNK_ORDER_DATE_MOD = 17
ZERO_QUANTITY_MOD = 19
NULL_QUANTITY_MOD = 23
NULL_REFUND_MOD = 31
NULL_UPC_MOD = 17
NULL_PRODUCT_ID_MOD = 53
NULL_VENDOR_ID_MOD = 37
JUNK_DATE_TEXT = "n/a"
# market segment → raw segment code as the regional files write it
SEGMENT_CODES = (
    ("BUILDING", "CONS"),
    ("HOUSEHOLD", "Consumer"),
    ("MACHINERY", "Corporate"),
    ("FURNITURE", "Home Office"),
    ("AUTOMOBILE", "Other"),
)
# order priority → raw ship mode text
SHIP_MODES = (("1-URGENT", "1st Class"), ("2-HIGH", "First Class"))
# a line is returned when flagged R
RETURN_FLAG = "R"
UPC_BASE = 600000000000
UPC_STEP = 7


def _text(c: Column) -> Column:
    return c.cast("string")


def _unless(mod_key: Column, modulus: int, value: Column) -> Column:
    return F.when(mod_key % modulus != 0, value)


def _lookup(c: Column, pairs, default: Column | None = None) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(default if default is not None else c)


def sales_amount(price: Column, discount: Column) -> Column:
    return price * (F.lit(1.0) - discount)


def raw_customers(t: Tables) -> DataFrame:
    """Two regional header styles unioned by name: even nations write
    ``Customer ID / Customer Email / Customer Name``, odd nations
    ``cust_id / email_address / full_name``."""
    c = t.read("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    geo = t.read("nation", ["n_nationkey", "n_regionkey"]).join(
        t.read("region", ["r_regionkey", "r_name"]), F.col("n_regionkey") == F.col("r_regionkey")
    )
    # nation → region is a fixed 25-row dimension (proven size bound): broadcast
    # it rather than let a size estimate shuffle the customer table by nation
    df = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "left")
    key = F.col("c_custkey")
    even = F.col("c_nationkey") % 2 == 0
    cid = _unless(key, NULL_CUSTOMER_ID_MOD, _text(key))
    email = _unless(key, NULL_EMAIL_MOD, F.concat(F.lower("c_name"), F.lit("@example.com")))
    segment = _unless(key, NULL_SEGMENT_MOD, _lookup(F.col("c_mktsegment"), SEGMENT_CODES))
    return df.select(
        F.when(even, cid).alias("Customer ID"),
        F.when(~even, cid).alias("cust_id"),
        F.when(even, email).alias("Customer Email"),
        F.when(~even, email).alias("email_address"),
        F.when(even, F.col("c_name")).alias("Customer Name"),
        F.when(~even, F.col("c_name")).alias("full_name"),
        segment.alias("Segment"),
        F.col("r_name").alias("Region"),
    )


def raw_orders(t: Tables) -> DataFrame:
    """Vendor = smallest supplier on the order's lines (NULL for orders with no
    lines); purchase date alternates two text formats, junk on some keys."""
    o = t.read("orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    vendor = t.read("lineitem", ["l_orderkey", "l_suppkey"]).groupBy("l_orderkey").agg(F.min("l_suppkey").alias("vendor"))
    df = o.join(vendor, o.o_orderkey == vendor.l_orderkey, "left")
    key = F.col("o_orderkey")
    ts = F.col("o_orderdate")
    date_text = (
        F.when(key % JUNK_ORDER_DATE_MOD == 0, F.lit(JUNK_DATE_TEXT))
        .when(key % 2 == 0, F.date_format(ts, "MM/dd/yyyy HH:mm"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm"))
    )
    return df.select(
        _text(key).alias("Order ID"),
        _text(F.col("o_custkey")).alias("Customer ID"),
        _text(F.col("vendor")).alias("Vendor ID"),
        _lookup(F.col("o_orderpriority"), SHIP_MODES).alias("Ship Mode"),
        date_text.alias("Order Purchase Date"),
    )


def raw_transactions(t: Tables) -> DataFrame:
    """One row per line item; discount as ``7%`` on even line numbers and
    ``0.07`` on odd ones; some quantities zero or missing."""
    li = t.read("lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"])
    part = F.col("l_partkey")
    sales = sales_amount(F.col("l_extendedprice"), F.col("l_discount"))
    profit = sales - F.lit(0.8) * F.col("l_extendedprice")
    discount = F.when(
        F.col("l_linenumber") % 2 == 0,
        F.concat(_text(F.round(F.col("l_discount") * 100).cast("int")), F.lit("%")),
    ).otherwise(_text(F.col("l_discount")))
    quantity = (
        F.when(part % NULL_QUANTITY_MOD == 0, F.lit(None).cast("string"))
        .when(part % ZERO_QUANTITY_MOD == 0, F.lit("0"))
        .otherwise(_text(F.col("l_quantity").cast("int")))
    )
    return li.select(
        _text(F.col("l_orderkey")).alias("Order ID"),
        _text(part).alias("ProductID"),
        _text(sales).alias("Sales"),
        quantity.alias("Quantity"),
        discount.alias("Discount"),
        _text(profit).alias("Profit"),
    )


def returned_lines(t: Tables) -> DataFrame:
    li = t.read(
        "lineitem",
        ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    return li.filter(F.col("l_returnflag") == RETURN_FLAG)


def raw_returns(t: Tables) -> DataFrame:
    """Returned lines: refund text with or without ``$``, status codes, return
    date in two formats."""
    li = returned_lines(t)
    sales = _text(sales_amount(F.col("l_extendedprice"), F.col("l_discount")))
    amount = _unless(
        F.col("l_partkey"),
        NULL_REFUND_MOD,
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("$"), sales)).otherwise(sales),
    )
    status = F.when(F.col("l_linestatus") == "F", F.lit("APPRVD")).otherwise(F.lit("pendg"))
    date_text = F.when(F.col("l_orderkey") % 2 == 0, F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise(
        F.date_format("l_shipdate", "MM/dd/yyyy")
    )
    return li.select(
        _text(F.col("l_orderkey")).alias("OrderId"),
        amount.alias("Amount"),
        status.alias("Status"),
        date_text.alias("Return Date"),
    )


def raw_products(t: Tables) -> DataFrame:
    """Part rows; UPC as 12 digits, in scientific text on even keys."""
    p = t.read("part", ["p_partkey", "p_name", "p_brand", "p_type"])
    key = F.col("p_partkey")
    digits = _text(F.lit(UPC_BASE) + key * UPC_STEP)
    sci = F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 11), F.lit("E+11"))
    upc = _unless(key, NULL_UPC_MOD, F.when(key % 2 == 0, sci).otherwise(digits))
    return p.select(
        _unless(key, NULL_PRODUCT_ID_MOD, _text(key)).alias("ProductID"),
        F.col("p_name").alias("Product Name"),
        F.col("p_brand").alias("Brand"),
        F.col("p_type").alias("Categories"),
        upc.alias("UPC"),
    )


def raw_vendors(t: Tables) -> DataFrame:
    s = t.read("supplier", ["s_suppkey", "s_name"])
    key = F.col("s_suppkey")
    return s.select(_unless(key, NULL_VENDOR_ID_MOD, _text(key)).alias("VendorID"), F.lower("s_name").alias("Vendor Name"))


BUILDERS = {
    "customers": raw_customers,
    "orders": raw_orders,
    "transactions": raw_transactions,
    "returns": raw_returns,
    "products": raw_products,
    "vendors": raw_vendors,
}


class RawEntities(Mapping):
    """The six raw frames, each built on first use (a query touching two
    entities never resolves the other four tables)."""

    def __init__(self, t: Tables):
        self._t = t
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, entity: str) -> DataFrame:
        if entity not in self._built:
            self._built[entity] = BUILDERS[entity](self._t)
        return self._built[entity]

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


def raw_entities(t: Tables) -> RawEntities:
    return RawEntities(t)
