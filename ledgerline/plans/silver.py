"""Silver: per-entity standardization + DQ rules on a Bronze-shaped frame.

Each ``*_base`` takes a raw frame (batch or streaming) and returns the base
view with canonical columns, ``_dq_*`` flags, ``_is_valid`` and
``_dq_reason``. The clean / quarantine tables are filters of it
(``operators.quality.clean`` / ``quarantine``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.columns import ALIASES, column_or_null, normalize_columns, resolve_alias
from ..functions.measures import in_range
from ..operators.dedupe import latest_by_key
from ..operators.quality import REASON, VALID, Rule, apply_rules, dq_flag_columns


@dataclass(frozen=True)
class SilverOptions:
    """Defaults follow the documented intent; each option restores the
    reference's literal behaviour."""

    alias_mode: str = "coalesce"  # "first_column" = parity (D3)
    null_policy: str = "fail"  # "drop" = parity (D1)
    discount_mode: str = "percent_aware"  # "as_written" = parity (D2)
    dedupe_lookup: bool = True  # False = parity (D6)
    keep_raw: bool = False  # keep unconsumed raw columns in the base view


CANONICAL = {
    "customers": ["customer_id", "customer_email", "customer_name", "segment", "region"],
    "orders": ["order_id", "customer_id", "vendor_id", "region", "ship_mode", "order_purchase_date"],
    "transactions": ["order_id", "product_id", "discount", "sales", "profit", "quantity"],
    "returns": ["order_id", "refund_amount", "return_status_raw", "return_status", "return_date"],
    "products": ["product_id", "product_name", "brand", "categories", "upc"],
    "vendors": ["vendor_id", "vendor_name"],
}
ENTITIES = tuple(CANONICAL)


def _alias(df: DataFrame, entity: str, field: str, opts: SilverOptions):
    return resolve_alias(df, ALIASES[entity][field], opts.alias_mode)


PROVENANCE = ("source_file", "ingestion_timestamp")


def _finish(df: DataFrame, entity: str, opts: SilverOptions) -> DataFrame:
    """Canonical columns, Bronze provenance when present, DQ columns."""
    cols = CANONICAL[entity] + [c for c in PROVENANCE if c in df.columns] + dq_flag_columns(df) + [VALID, REASON]
    if opts.keep_raw:
        cols = [c for c in df.columns if c not in cols] + cols
    return df.select(*cols)


def customer_rules() -> list[Rule]:
    return [
        Rule("_dq_id_ok", F.col("customer_id").isNotNull(), "Missing customer_id"),
        Rule("_dq_email_ok", F.col("customer_email").isNotNull(), "Missing customer_email"),
        Rule("_dq_segment_ok", F.col("segment").isin(*C.VALID_SEGMENTS), "Invalid segment value"),
    ]


def customers_base(raw: DataFrame, opts: SilverOptions = SilverOptions()) -> DataFrame:
    df = normalize_columns(raw)
    df = df.withColumns(
        {
            "customer_id": _alias(df, "customers", "customer_id", opts),
            "customer_email": _alias(df, "customers", "customer_email", opts),
            "customer_name": _alias(df, "customers", "customer_name", opts),
            "segment": C.segment_label(column_or_null(df, "segment")),
            "region": column_or_null(df, "region"),
        }
    )
    return _finish(apply_rules(df, customer_rules(), opts.null_policy), "customers", opts)


def region_lookup(customers_clean: DataFrame, opts: SilverOptions = SilverOptions()) -> DataFrame:
    """customer_id → region from clean customers, one row per id when
    ``dedupe_lookup`` (so duplicate customer rows never multiply orders)."""
    if not opts.dedupe_lookup:
        return customers_clean.select("customer_id", "region")
    if "ingestion_timestamp" in customers_clean.columns:  # latest ingested row wins
        lookup = customers_clean.select("customer_id", "region", "ingestion_timestamp")
        return latest_by_key(lookup, ["customer_id"], order_by=["ingestion_timestamp"]).select("customer_id", "region")
    return latest_by_key(customers_clean.select("customer_id", "region"), ["customer_id"])


ORDER_FIELDS = ("order_id", "customer_id", "vendor_id", "ship_mode", "order_purchase_date")


def order_rules() -> list[Rule]:
    return [
        Rule("_dq_order", F.col("order_id").isNotNull(), "Missing order_id"),
        Rule("_dq_customer", F.col("customer_id").isNotNull(), "Missing customer_id"),
        Rule("_dq_vendor", F.col("vendor_id").isNotNull(), "Missing vendor_id"),
        Rule("_dq_region", F.col("region").isNotNull(), "Missing region"),
    ]


def _with_region(orders: DataFrame, customers_clean: DataFrame, opts: SilverOptions) -> DataFrame:
    o = orders.alias("o")
    lookup = region_lookup(customers_clean, opts).alias("c")
    extra = [f"o.{c}" for c in PROVENANCE if c in orders.columns]
    return o.join(lookup, F.col("o.customer_id") == F.col("c.customer_id"), "left").select(
        "o.order_id", "o.customer_id", "o.vendor_id", F.col("c.region").alias("region"), "o.ship_mode", "o.order_purchase_date", *extra
    )


def orders_base(raw: DataFrame, customers_clean: DataFrame, opts: SilverOptions = SilverOptions()) -> DataFrame:
    """Region is frozen onto the order from the customers known when the
    order is processed (left join; J1)."""
    o = normalize_columns(raw)
    o = o.select(*[column_or_null(o, c).cast("string").alias(c) for c in ORDER_FIELDS], *[c for c in PROVENANCE if c in o.columns])
    df = _with_region(o, customers_clean, opts).withColumns(
        {
            "ship_mode": C.ship_mode_label(F.col("ship_mode")),
            "order_purchase_date": C.parse_timestamp(F.col("order_purchase_date")),
        }
    )
    return _finish(apply_rules(df, order_rules(), opts.null_policy), "orders", opts)


def transaction_rules() -> list[Rule]:
    return [
        Rule("_dq_order", F.col("order_id").isNotNull(), "Missing order_id"),
        Rule("_dq_product", F.col("product_id").isNotNull(), "Missing product_id"),
        Rule("_dq_qty", F.col("quantity") > 0, "Invalid quantity"),
        Rule("_dq_amount", in_range("sales") & in_range("profit"), "Amount out of range"),
    ]


def transactions_base(raw: DataFrame, opts: SilverOptions = SilverOptions()) -> DataFrame:
    df = normalize_columns(raw)
    df = df.withColumns(
        {
            "order_id": _alias(df, "transactions", "order_id", opts),
            "product_id": _alias(df, "transactions", "product_id", opts),
            "discount": C.percent_to_fraction(column_or_null(df, "discount"), opts.discount_mode),
            "quantity": C.to_int(column_or_null(df, "quantity")),
            "sales": C.to_double(column_or_null(df, "sales")),
            "profit": C.to_double(column_or_null(df, "profit")),
        }
    )
    return _finish(apply_rules(df, transaction_rules(), opts.null_policy), "transactions", opts)


def return_rules() -> list[Rule]:
    return [
        Rule("_dq_order", F.col("order_id").isNotNull(), "Missing order_id"),
        Rule("_dq_refund", F.col("refund_amount").isNotNull(), "Missing refund_amount"),
        Rule("_dq_amount", in_range("refund_amount"), "Amount out of range"),
    ]


def returns_base(raw: DataFrame, opts: SilverOptions = SilverOptions()) -> DataFrame:
    df = normalize_columns(raw)
    raw_status = F.upper(_alias(df, "returns", "return_status", opts))
    df = df.withColumns(
        {
            "order_id": _alias(df, "returns", "order_id", opts),
            "refund_amount": C.currency_to_double(_alias(df, "returns", "refund_amount", opts)),
            "return_status_raw": raw_status,
            "return_status": C.return_status_label(raw_status),
            "return_date": C.parse_date(_alias(df, "returns", "return_date", opts)),
        }
    )
    return _finish(apply_rules(df, return_rules(), opts.null_policy), "returns", opts)


def product_rules() -> list[Rule]:
    return [Rule("_dq_product", F.col("product_id").isNotNull(), "Missing product_id")]


def products_base(raw: DataFrame, opts: SilverOptions = SilverOptions()) -> DataFrame:
    df = normalize_columns(raw)
    df = df.withColumns(
        {
            "product_id": _alias(df, "products", "product_id", opts),
            "product_name": column_or_null(df, "product_name"),
            "brand": column_or_null(df, "brand"),
            "categories": column_or_null(df, "categories"),
            "upc": C.upc_digits(column_or_null(df, "upc")),
        }
    )
    return _finish(apply_rules(df, product_rules(), opts.null_policy), "products", opts)


def vendor_rules() -> list[Rule]:
    return [Rule("_dq_vendor", F.col("vendor_id").isNotNull(), "Missing vendor_id")]


def vendors_base(raw: DataFrame, opts: SilverOptions = SilverOptions()) -> DataFrame:
    df = normalize_columns(raw)
    df = df.withColumns(
        {
            "vendor_id": _alias(df, "vendors", "vendor_id", opts),
            "vendor_name": C.title_case(column_or_null(df, "vendor_name")),
        }
    )
    return _finish(apply_rules(df, vendor_rules(), opts.null_policy), "vendors", opts)


def replay_quarantine(orders_quarantine: DataFrame, customers_clean: DataFrame, opts: SilverOptions = SilverOptions()) -> DataFrame:
    """Re-run the order rules for quarantined orders against today's customers
    (D7): an order that arrived before its customer is recovered. Returns the
    re-evaluated base; its clean side is what moves to ``orders_silver``."""
    q = orders_quarantine.select(*ORDER_FIELDS, *[c for c in PROVENANCE if c in orders_quarantine.columns])
    df = _with_region(q, customers_clean, opts)
    return _finish(apply_rules(df, order_rules(), opts.null_policy), "orders", opts)


BASES = {
    "customers": customers_base,
    "transactions": transactions_base,
    "returns": returns_base,
    "products": products_base,
    "vendors": vendors_base,
}

RULES = {
    "customers": customer_rules,
    "orders": order_rules,
    "transactions": transaction_rules,
    "returns": return_rules,
    "products": product_rules,
    "vendors": vendor_rules,
}


def rule_reasons(entity: str) -> dict[str, str]:
    """Flag column → reason text of an entity's rules."""
    return {r.flag: r.reason for r in RULES[entity]()}
