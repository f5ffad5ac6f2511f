"""Independent DuckDB SQL for the correctness gate.

The same testbed mapping, Silver rules and Gold definitions, written as plain
ANSI-ish SQL over the driver's pre-registered views. Each body in
``BODIES`` becomes ``WITH <shared CTEs> SELECT …`` (``oracle_sql()``).
"""

from __future__ import annotations

from ..sources import testbed as TB

_CTES = f"""
geo AS (
  SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
raw_customers AS (
  SELECT
    c.c_nationkey % 2 = 0 AS even_nation,
    CASE WHEN c.c_custkey % {TB.NULL_CUSTOMER_ID_MOD} <> 0 THEN CAST(c.c_custkey AS VARCHAR) END AS cid,
    CASE WHEN c.c_custkey % {TB.NULL_EMAIL_MOD} <> 0 THEN lower(c.c_name) || '@example.com' END AS email,
    c.c_name AS cname,
    CASE WHEN c.c_custkey % {TB.NULL_SEGMENT_MOD} <> 0 THEN
      CASE c.c_mktsegment WHEN 'BUILDING' THEN 'CONS' WHEN 'HOUSEHOLD' THEN 'Consumer'
        WHEN 'MACHINERY' THEN 'Corporate' WHEN 'FURNITURE' THEN 'Home Office'
        WHEN 'AUTOMOBILE' THEN 'Other' ELSE c.c_mktsegment END
    END AS segment,
    g.r_name AS region
  FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey
),
customers_norm AS (
  SELECT
    CASE WHEN even_nation THEN cid END AS customer_id,
    CASE WHEN NOT even_nation THEN cid END AS cust_id,
    CASE WHEN even_nation THEN email END AS customer_email,
    CASE WHEN NOT even_nation THEN email END AS email_address,
    CASE WHEN even_nation THEN cname END AS customer_name,
    CASE WHEN NOT even_nation THEN cname END AS full_name,
    segment, region
  FROM raw_customers
),
customers_h AS (
  SELECT
    coalesce(customer_id, cust_id) AS customer_id,
    coalesce(customer_email, email_address) AS customer_email,
    coalesce(customer_name, full_name) AS customer_name,
    CASE WHEN segment = 'CONS' THEN 'Consumer' ELSE segment END AS segment,
    region
  FROM customers_norm
),
customers_f AS (
  SELECT *,
    coalesce(customer_id IS NOT NULL, false) AS _dq_id_ok,
    coalesce(customer_email IS NOT NULL, false) AS _dq_email_ok,
    coalesce(segment IN ('Consumer', 'Corporate', 'Home Office'), false) AS _dq_segment_ok
  FROM customers_h
),
customers_base AS (
  SELECT *,
    _dq_id_ok AND _dq_email_ok AND _dq_segment_ok AS _is_valid,
    CASE WHEN NOT _dq_id_ok THEN 'Missing customer_id'
         WHEN NOT _dq_email_ok THEN 'Missing customer_email'
         WHEN NOT _dq_segment_ok THEN 'Invalid segment value' END AS _dq_reason
  FROM customers_f
),
customers_clean AS (SELECT * FROM customers_base WHERE _is_valid),
vendor_of_order AS (
  SELECT l_orderkey, min(l_suppkey) AS vendor FROM lineitem GROUP BY l_orderkey
),
orders_norm AS (
  SELECT
    CAST(o.o_orderkey AS VARCHAR) AS order_id,
    CAST(o.o_custkey AS VARCHAR) AS customer_id,
    CAST(v.vendor AS VARCHAR) AS vendor_id,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN '1st Class' WHEN '2-HIGH' THEN 'First Class'
      ELSE o.o_orderpriority END AS ship_mode,
    CASE WHEN o.o_orderkey % {TB.JUNK_ORDER_DATE_MOD} = 0 THEN '{TB.JUNK_DATE_TEXT}'
         WHEN o.o_orderkey % 2 = 0 THEN strftime(o.o_orderdate, '%m/%d/%Y %H:%M')
         ELSE strftime(o.o_orderdate, '%Y-%m-%d %H:%M') END AS order_purchase_date
  FROM orders o LEFT JOIN vendor_of_order v ON o.o_orderkey = v.l_orderkey
),
region_lookup AS (
  SELECT customer_id, max(region) AS region FROM customers_clean GROUP BY customer_id
),
orders_f AS (
  SELECT
    o.order_id, o.customer_id, o.vendor_id, c.region,
    CASE WHEN o.ship_mode IN ('1st Class', 'First Class') THEN 'First Class' ELSE o.ship_mode END AS ship_mode,
    coalesce(try_strptime(o.order_purchase_date, '%m/%d/%Y %H:%M'),
             try_strptime(o.order_purchase_date, '%Y-%m-%d %H:%M')) AS order_purchase_date,
    coalesce(o.order_id IS NOT NULL, false) AS _dq_order,
    coalesce(o.customer_id IS NOT NULL, false) AS _dq_customer,
    coalesce(o.vendor_id IS NOT NULL, false) AS _dq_vendor,
    coalesce(c.region IS NOT NULL, false) AS _dq_region
  FROM orders_norm o LEFT JOIN region_lookup c ON o.customer_id = c.customer_id
),
orders_base AS (
  SELECT *,
    _dq_order AND _dq_customer AND _dq_vendor AND _dq_region AS _is_valid,
    CASE WHEN NOT _dq_order THEN 'Missing order_id'
         WHEN NOT _dq_customer THEN 'Missing customer_id'
         WHEN NOT _dq_vendor THEN 'Missing vendor_id'
         WHEN NOT _dq_region THEN 'Missing region' END AS _dq_reason
  FROM orders_f
),
orders_clean AS (SELECT * FROM orders_base WHERE _is_valid),
transactions_raw AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%'
         ELSE CAST(l_discount AS VARCHAR) END AS discount_text,
    l_extendedprice * (1.0 - l_discount) AS sales,
    CASE WHEN l_partkey % {TB.NULL_QUANTITY_MOD} = 0 THEN NULL
         WHEN l_partkey % {TB.ZERO_QUANTITY_MOD} = 0 THEN 0
         ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    l_extendedprice * (1.0 - l_discount) - 0.8 * l_extendedprice AS profit
  FROM lineitem
),
transactions_f AS (
  SELECT order_id, product_id,
    CASE WHEN contains(discount_text, '%') THEN TRY_CAST(replace(discount_text, '%', '') AS DOUBLE) / 100.0
         ELSE TRY_CAST(discount_text AS DOUBLE) END AS discount,
    sales, profit, quantity,
    coalesce(order_id IS NOT NULL, false) AS _dq_order,
    coalesce(product_id IS NOT NULL, false) AS _dq_product,
    coalesce(quantity > 0, false) AS _dq_qty,
    (sales IS NULL OR abs(sales) < 1e18) AND (profit IS NULL OR abs(profit) < 1e18) AS _dq_amount
  FROM transactions_raw
),
transactions_base AS (
  SELECT *,
    _dq_order AND _dq_product AND _dq_qty AND _dq_amount AS _is_valid,
    CASE WHEN NOT _dq_order THEN 'Missing order_id'
         WHEN NOT _dq_product THEN 'Missing product_id'
         WHEN NOT _dq_qty THEN 'Invalid quantity'
         WHEN NOT _dq_amount THEN 'Amount out of range' END AS _dq_reason
  FROM transactions_f
),
transactions_clean AS (SELECT * FROM transactions_base WHERE _is_valid),
returns_raw AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) AS order_id,
    CASE WHEN l_partkey % {TB.NULL_REFUND_MOD} <> 0 THEN l_extendedprice * (1.0 - l_discount) END AS refund_amount,
    CASE WHEN l_linenumber % 2 = 0 THEN '$' ELSE '' END AS refund_prefix,
    CASE WHEN l_linestatus = 'F' THEN 'APPRVD' ELSE 'pendg' END AS status,
    CASE WHEN l_orderkey % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%m/%d/%Y') END AS date_text
  FROM lineitem
  WHERE l_returnflag = '{TB.RETURN_FLAG}'
),
returns_f AS (
  SELECT order_id, refund_amount,
    upper(status) AS return_status_raw,
    CASE WHEN upper(status) IN ('REJECTED', 'RJCTD') THEN 'Rejected'
         WHEN upper(status) IN ('APPROVED', 'APPRVD') THEN 'Approved'
         WHEN upper(status) IN ('PENDING', 'PENDG') THEN 'Pending'
         ELSE 'Unknown' END AS return_status,
    CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%m/%d/%Y')) AS DATE) AS return_date,
    coalesce(order_id IS NOT NULL, false) AS _dq_order,
    coalesce(refund_amount IS NOT NULL, false) AS _dq_refund,
    (refund_amount IS NULL OR abs(refund_amount) < 1e18) AS _dq_amount
  FROM returns_raw
),
returns_base AS (
  SELECT *,
    _dq_order AND _dq_refund AND _dq_amount AS _is_valid,
    CASE WHEN NOT _dq_order THEN 'Missing order_id'
         WHEN NOT _dq_refund THEN 'Missing refund_amount'
         WHEN NOT _dq_amount THEN 'Amount out of range' END AS _dq_reason
  FROM returns_f
),
returns_clean AS (SELECT * FROM returns_base WHERE _is_valid),
products_raw AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % {TB.NULL_PRODUCT_ID_MOD} <> 0 THEN CAST(p_partkey AS VARCHAR) END AS product_id,
    p_name AS product_name, p_brand AS brand, p_type AS categories,
    CASE WHEN p_partkey % {TB.NULL_UPC_MOD} <> 0 THEN
      CASE WHEN p_partkey % 2 = 0
           THEN substr(CAST({TB.UPC_BASE} + p_partkey * {TB.UPC_STEP} AS VARCHAR), 1, 1) || '.' ||
                substr(CAST({TB.UPC_BASE} + p_partkey * {TB.UPC_STEP} AS VARCHAR), 2, 11) || 'E+11'
           ELSE CAST({TB.UPC_BASE} + p_partkey * {TB.UPC_STEP} AS VARCHAR) END
    END AS upc_text
  FROM part
),
products_base AS (
  SELECT product_id, product_name, brand, categories,
    CASE WHEN TRY_CAST(upc_text AS DOUBLE) IS NOT NULL THEN printf('%.0f', TRY_CAST(upc_text AS DOUBLE)) END AS upc,
    coalesce(product_id IS NOT NULL, false) AS _dq_product,
    coalesce(product_id IS NOT NULL, false) AS _is_valid,
    CASE WHEN product_id IS NULL THEN 'Missing product_id' END AS _dq_reason
  FROM products_raw
),
products_clean AS (SELECT * FROM products_base WHERE _is_valid),
vendors_raw AS (
  SELECT CASE WHEN s_suppkey % {TB.NULL_VENDOR_ID_MOD} <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS vendor_id,
    lower(s_name) AS vendor_name_raw FROM supplier
),
vendors_base AS (
  SELECT vendor_id,
    array_to_string(list_transform(string_split(lower(vendor_name_raw), ' '),
                                   lambda w: upper(w[1]) || w[2:]), ' ') AS vendor_name,
    coalesce(vendor_id IS NOT NULL, false) AS _dq_vendor,
    coalesce(vendor_id IS NOT NULL, false) AS _is_valid,
    CASE WHEN vendor_id IS NULL THEN 'Missing vendor_id' END AS _dq_reason
  FROM vendors_raw
),
vendors_clean AS (SELECT * FROM vendors_base WHERE _is_valid),
fact_transactions AS (
  SELECT o.order_id, o.customer_id, o.vendor_id, t.product_id, o.region,
    o.order_purchase_date AS date,
    CAST(strftime(o.order_purchase_date, '%Y%m%d') AS INTEGER) AS date_key,
    t.sales AS sales_amount, t.quantity, t.profit
  FROM orders_clean o JOIN transactions_clean t ON o.order_id = t.order_id
),
fact_returns AS (
  SELECT r.order_id, o.customer_id, o.vendor_id, r.refund_amount, r.return_status,
    r.return_date AS date, CAST(strftime(r.return_date, '%Y%m%d') AS INTEGER) AS date_key
  FROM returns_clean r JOIN orders_clean o ON r.order_id = o.order_id
),
agg_monthly_revenue AS (
  SELECT region, strftime(date, '%Y-%m') AS month,
    CAST(sum(CAST(sales_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_sales,
    count(DISTINCT order_id) AS order_count
  FROM fact_transactions GROUP BY region, strftime(date, '%Y-%m')
),
agg_customer_returns AS (
  SELECT customer_id, count(*) AS return_count,
    CAST(sum(CAST(refund_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_refund_amount
  FROM fact_returns GROUP BY customer_id
),
agg_vendor_performance AS (
  SELECT s.vendor_id, s.total_orders, coalesce(r.total_returns, 0) AS total_returns,
    coalesce(r.total_returns, 0) * 1.0 / s.total_orders AS return_rate
  FROM (SELECT vendor_id, count(DISTINCT order_id) AS total_orders FROM fact_transactions GROUP BY vendor_id) s
  LEFT JOIN (SELECT vendor_id, count(*) AS total_returns FROM fact_returns GROUP BY vendor_id) r
    ON s.vendor_id = r.vendor_id
),
agg_slow_moving_products AS (
  SELECT product_id, region, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold
  FROM fact_transactions GROUP BY product_id, region HAVING sum(quantity) < 10
),
return_profile AS (
  SELECT customer_id, count(*) AS total_returns,
    CAST(sum(CAST(refund_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_return_value,
    max(date) AS latest_return_date,
    count(*) FILTER (WHERE date >= CAST((SELECT max(date) FROM fact_returns) - INTERVAL 30 DAY AS DATE)) AS last_30_day_returns
  FROM fact_returns GROUP BY customer_id
),
sales_profile AS (
  SELECT customer_id, count(DISTINCT order_id) AS total_orders,
    CAST(sum(CAST(sales_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_sales_value
  FROM fact_transactions GROUP BY customer_id
),
customer_return_profile AS (
  SELECT r.*, coalesce(s.total_orders, 0) AS total_orders, coalesce(s.total_sales_value, 0.0) AS total_sales_value,
    r.total_returns / CASE WHEN coalesce(s.total_orders, 0) = 0 THEN 1 ELSE coalesce(s.total_orders, 0) END AS return_to_order_ratio
  FROM return_profile r LEFT JOIN sales_profile s ON r.customer_id = s.customer_id
),
rule_points AS (
  SELECT *,
    CASE WHEN total_returns >= 5 THEN 25 ELSE 0 END AS rule_high_volume,
    CASE WHEN total_return_value >= 25000 THEN 20 ELSE 0 END AS rule_high_value,
    CASE WHEN return_to_order_ratio >= 0.5 THEN 25 ELSE 0 END AS rule_high_ratio,
    CASE WHEN last_30_day_returns >= 3 THEN 20 ELSE 0 END AS rule_recent_spike,
    CASE WHEN total_return_value > total_sales_value THEN 10 ELSE 0 END AS rule_refund_dominance
  FROM customer_return_profile
),
anomaly_score AS (
  SELECT *,
    CAST(rule_high_volume + rule_high_value + rule_high_ratio + rule_recent_spike + rule_refund_dominance AS INTEGER) AS anomaly_score,
    concat_ws(', ',
      CASE WHEN rule_high_volume > 0 THEN 'High return volume' END,
      CASE WHEN rule_high_value > 0 THEN 'High refund value' END,
      CASE WHEN rule_high_ratio > 0 THEN 'High return-to-order ratio' END,
      CASE WHEN rule_recent_spike > 0 THEN 'Recent return spike' END,
      CASE WHEN rule_refund_dominance > 0 THEN 'Refunds exceed purchases' END) AS violated_rules
  FROM rule_points
),
flagged AS (SELECT * FROM anomaly_score WHERE anomaly_score >= 40),
kpi_revenue AS (
  -- by way of text: a double is read by its shortest decimal form, not its binary expansion
  SELECT region, CAST(sum(CAST(CAST(total_sales AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue,
    CAST(sum(order_count) AS BIGINT) AS total_orders
  FROM agg_monthly_revenue GROUP BY region
),
kpi_vendor AS (
  SELECT vendor_id, avg(return_rate) AS avg_return_rate, CAST(sum(total_returns) AS BIGINT) AS total_returns,
    CAST(sum(total_orders) AS BIGINT) AS total_orders
  FROM agg_vendor_performance GROUP BY vendor_id
),
kpi_slow_moving AS (
  SELECT region, count(product_id) AS slow_product_count, CAST(sum(total_quantity_sold) AS BIGINT) AS total_quantity_sold
  FROM agg_slow_moving_products GROUP BY region
)
"""


def with_ctes(body: str) -> str:
    return "WITH " + _CTES.strip() + "," + _retrieval_ctes() + "\n" + body.strip()


BODIES: dict[str, str] = {
    "dim_customer": "SELECT customer_id, max(customer_name) AS customer_name, max(customer_email) AS customer_email, "
    "max(segment) AS segment, max(region) AS region FROM customers_clean GROUP BY customer_id",
    "dim_product": "SELECT product_id, max(product_name) AS product_name, max(categories) AS categories, "
    "max(brand) AS brand, max(upc) AS upc FROM products_clean GROUP BY product_id",
    "dim_vendor": "SELECT vendor_id, max(vendor_name) AS vendor_name FROM vendors_clean GROUP BY vendor_id",
    "dim_date": """
        SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
               CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               CAST(day(date) AS INTEGER) AS day
        FROM (SELECT CAST(order_purchase_date AS DATE) AS date FROM orders_clean
              UNION SELECT return_date FROM returns_clean) d
        WHERE date IS NOT NULL""",
    "fact_transactions": "SELECT * FROM fact_transactions",
    "fact_returns": "SELECT * FROM fact_returns",
    "agg_monthly_revenue": "SELECT * FROM agg_monthly_revenue",
    "agg_customer_returns": "SELECT * FROM agg_customer_returns",
    "agg_vendor_performance": "SELECT * FROM agg_vendor_performance",
    "agg_slow_moving_products": "SELECT * FROM agg_slow_moving_products",
}


ENTITY_FLAGS = {
    "customers": ["_dq_id_ok", "_dq_email_ok", "_dq_segment_ok"],
    "orders": ["_dq_order", "_dq_customer", "_dq_vendor", "_dq_region"],
    "transactions": ["_dq_order", "_dq_product", "_dq_qty", "_dq_amount"],
    "returns": ["_dq_order", "_dq_refund", "_dq_amount"],
    "products": ["_dq_product"],
    "vendors": ["_dq_vendor"],
}

for _e in ENTITY_FLAGS:
    BODIES[f"clean_{_e}"] = f"SELECT * FROM {_e}_base WHERE _is_valid"
    BODIES[f"quarantine_{_e}"] = f"SELECT * FROM {_e}_base WHERE NOT _is_valid"

_FAILURES = " UNION ALL ".join(
    f"SELECT '{f}' AS field_name, trim(lower(_dq_reason)) AS issue_type, count(*) AS failed_count, "
    f"'{e}' AS entity_name FROM {e}_base WHERE NOT _is_valid AND NOT {f} GROUP BY _dq_reason"
    for e, flags in ENTITY_FLAGS.items()
    for f in flags
)


# written out here, apart from the rules under test
_OWN_REASON = {
    "_dq_id_ok": "missing customer_id",
    "_dq_email_ok": "missing customer_email",
    "_dq_segment_ok": "invalid segment value",
    "_dq_order": "missing order_id",
    "_dq_customer": "missing customer_id",
    "_dq_vendor": "missing vendor_id",
    "_dq_region": "missing region",
    "_dq_product": "missing product_id",
    "_dq_qty": "invalid quantity",
    "_dq_amount": "amount out of range",
    "_dq_refund": "missing refund_amount",
}
BODIES["dq_failure_counts_per_rule"] = " UNION ALL ".join(
    f"SELECT '{f}' AS field_name, '{_OWN_REASON[f]}' AS issue_type, count(*) AS failed_count, '{e}' AS entity_name "
    f"FROM {e}_base WHERE NOT _is_valid AND NOT {f} HAVING count(*) > 0"
    for e, flags in ENTITY_FLAGS.items()
    for f in flags
)


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _failure_cte() -> str:
    from .dq_report import IMPACT_TEMPLATE, PROMPT_TEMPLATE

    impact = f"printf({_sql_text(IMPACT_TEMPLATE)}, failed_count, entity_name, field_name, issue_type)"
    prompt = f"printf({_sql_text(PROMPT_TEMPLATE)}, entity_name, field_name, issue_type, failed_count)"
    return (
        f"(SELECT *, {prompt} AS prompt, {impact} AS business_impact, "
        f"to_json(struct_pack(entity_name := entity_name, issue_type := issue_type, business_impact := {impact})) AS reply "
        f"FROM ({_FAILURES}) f) x"
    )


BODIES.update(
    {
        "scan_orders_header": "SELECT * FROM orders_norm",
        "normalize_customers": "SELECT * FROM customers_norm",
        "harmonize_alias": """
            SELECT coalesce(customer_id, cust_id) AS customer_id, customer_id AS customer_id_first_column,
                   coalesce(customer_email, email_address) AS customer_email,
                   coalesce(customer_name, full_name) AS customer_name
            FROM customers_norm""",
        "segment_rule": """
            SELECT segment AS segment_raw, seg AS segment,
                   coalesce(seg IN ('Consumer', 'Corporate', 'Home Office'), false) AS segment_ok, count(*) AS n
            FROM (SELECT segment, CASE WHEN segment = 'CONS' THEN 'Consumer' ELSE segment END AS seg FROM customers_norm) s
            GROUP BY segment, seg""",
        "ship_mode_norm": """
            SELECT ship_mode AS ship_mode_raw,
                   CASE WHEN ship_mode IN ('1st Class', 'First Class') THEN 'First Class' ELSE ship_mode END AS ship_mode,
                   count(*) AS n
            FROM orders_norm GROUP BY 1, 2""",
        "return_status_norm": """
            SELECT r.status AS status_text, f.return_status_raw, f.return_status, count(*) AS n
            FROM (SELECT status, upper(status) AS u FROM returns_raw) r
            JOIN (SELECT DISTINCT return_status_raw, return_status FROM returns_f) f ON r.u = f.return_status_raw
            GROUP BY 1, 2, 3""",
        "discount_percent": """
            SELECT order_id, product_id, discount_text,
                   CASE WHEN contains(discount_text, '%') THEN TRY_CAST(replace(discount_text, '%', '') AS DOUBLE) / 100.0
                        ELSE TRY_CAST(discount_text AS DOUBLE) END AS discount,
                   CASE WHEN discount_text LIKE '%' THEN TRY_CAST(replace(discount_text, '%', '') AS DOUBLE) / 100.0
                        ELSE TRY_CAST(discount_text AS DOUBLE) END AS discount_as_written
            FROM transactions_raw""",
        "refund_clean": """
            SELECT order_id, CASE WHEN refund_amount IS NOT NULL THEN refund_prefix = '$' END AS had_symbol, refund_amount
            FROM returns_raw""",
        "order_date_parse": """
            SELECT order_id, order_purchase_date AS order_purchase_date_text,
                   coalesce(try_strptime(order_purchase_date, '%m/%d/%Y %H:%M'),
                            try_strptime(order_purchase_date, '%Y-%m-%d %H:%M')) AS order_purchase_date
            FROM orders_norm""",
        "return_date_parse": """
            SELECT order_id, date_text AS return_date_text,
                   CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%m/%d/%Y')) AS DATE) AS return_date
            FROM returns_raw""",
        "upc_digits": """
            SELECT product_id, upc_text,
                   CASE WHEN TRY_CAST(upc_text AS DOUBLE) IS NOT NULL THEN printf('%.0f', TRY_CAST(upc_text AS DOUBLE)) END AS upc
            FROM products_raw""",
        "vendor_initcap": """
            SELECT vendor_id, vendor_name_raw,
                   array_to_string(list_transform(string_split(lower(vendor_name_raw), ' '),
                                                  lambda w: upper(w[1]) || w[2:]), ' ') AS vendor_name
            FROM vendors_raw""",
        "orders_region_freeze": "SELECT order_id, customer_id, region, _dq_region, _is_valid, _dq_reason FROM orders_base",
        "split_accounting": " UNION ALL ".join(
            f"SELECT '{e}' AS entity_name, count(*) AS input_rows, count(*) FILTER (WHERE _is_valid) AS clean_rows, "
            f"count(*) FILTER (WHERE NOT _is_valid) AS quarantine_rows, count(*) FILTER (WHERE _is_valid IS NULL) AS unassigned_rows "
            f"FROM {e}_base"
            for e in ENTITY_FLAGS
        ),
        "split_accounting_parity": " UNION ALL ".join(
            [
                "SELECT 'customers' AS entity_name, count(*) AS input_rows, count(*) FILTER (WHERE v) AS clean_rows, "
                "count(*) FILTER (WHERE NOT v) AS quarantine_rows, count(*) FILTER (WHERE v IS NULL) AS unassigned_rows FROM "
                "(SELECT (customer_id IS NOT NULL) AND (customer_email IS NOT NULL) AND "
                "(segment IN ('Consumer', 'Corporate', 'Home Office')) AS v FROM customers_h) c",
                "SELECT 'transactions' AS entity_name, count(*) AS input_rows, count(*) FILTER (WHERE v) AS clean_rows, "
                "count(*) FILTER (WHERE NOT v) AS quarantine_rows, count(*) FILTER (WHERE v IS NULL) AS unassigned_rows FROM "
                "(SELECT (order_id IS NOT NULL) AND (product_id IS NOT NULL) AND (quantity > 0) AS v FROM transactions_raw) t",
            ]
            + [
                f"SELECT '{e}' AS entity_name, count(*) AS input_rows, count(*) FILTER (WHERE _is_valid) AS clean_rows, "
                f"count(*) FILTER (WHERE NOT _is_valid) AS quarantine_rows, count(*) FILTER (WHERE _is_valid IS NULL) AS unassigned_rows "
                f"FROM {e}_base"
                for e in ("orders", "returns", "products", "vendors")
            ]
        ),
        "dim_date_parity": """
            SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
                   CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
                   CAST(day(date) AS INTEGER) AS day
            FROM (SELECT order_purchase_date AS date FROM orders_clean
                  UNION SELECT CAST(return_date AS TIMESTAMP) FROM returns_clean) d""",
        "dq_unpivot": " UNION ALL ".join(
            f"SELECT customer_id, _dq_reason, '{f}' AS dq_field, {f} AS is_valid FROM customers_base" for f in ENTITY_FLAGS["customers"]
        ),
        "dq_failure_counts": _FAILURES,
    }
)


# written out here, apart from the code under test
_KPIS = {
    "revenue_performance": (
        "kpi_revenue",
        "region",
        "region := region, total_revenue := CAST(total_revenue AS DECIMAL(38,4)), total_orders := total_orders",
        "total_revenue",
        {"total_revenue": "CAST(sum(CAST(CAST(total_revenue AS VARCHAR) AS DECIMAL(38,10))) AS DECIMAL(38,4))", "total_orders": "CAST(sum(total_orders) AS BIGINT)"},
    ),
    "vendor_return_rate": (
        "kpi_vendor",
        "vendor_id",
        "vendor_id := vendor_id, avg_return_rate := CAST(avg_return_rate AS DECIMAL(20,6)), total_returns := total_returns, total_orders := total_orders",
        "CAST(avg_return_rate AS DECIMAL(20,6))",
        {"total_returns": "CAST(sum(total_returns) AS BIGINT)", "total_orders": "CAST(sum(total_orders) AS BIGINT)"},
    ),
    "slow_moving_inventory": (
        "kpi_slow_moving",
        "region",
        "region := region, slow_product_count := slow_product_count, total_quantity_sold := total_quantity_sold",
        "slow_product_count",
        {"slow_product_count": "CAST(sum(slow_product_count) AS BIGINT)", "total_quantity_sold": "CAST(sum(total_quantity_sold) AS BIGINT)"},
    ),
}
_LEADS = {"revenue_performance": "total_revenue", "vendor_return_rate": "avg_return_rate", "slow_moving_inventory": "slow_product_count"}


def _kpi_sql(itype: str, pages: bool, named: bool = True) -> str:
    """The insights: figures of whole views, or all entries in pages of about 20; ``named`` pages alone, or
    either kind with ``page`` (NULL for the whole view) and ``n_pages``."""
    view, key, fields, lead, totals = _KPIS[itype]
    n_pages = f"(SELECT greatest(1, (count(*) + 19) // 20) FROM {view})"
    page = f"coalesce(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % {n_pages}, 0)"
    sums = ", ".join(f"{sql} AS {name}" for name, sql in totals.items())
    text = " || ', ' || ".join(f"'{name} ' || coalesce(CAST({name} AS VARCHAR), 'unknown')" for name in totals)
    summary = (
        f"'{itype}: ' || n_entries || ' entries, ' || {text} || '; highest ' || coalesce(CAST(highest[1].{key} AS VARCHAR), 'none') || "
        f"', lowest ' || coalesce(CAST(lowest[1].{key} AS VARCHAR), 'none') || ' by {_LEADS[itype]}.'"
    )
    figures = f"to_json(struct_pack(n_entries := n_entries, {', '.join(f'{n} := {n}' for n in totals)}, highest := highest, lowest := lowest))"
    data = "to_json(entries)" if pages else figures
    if named:
        node = "CAST(node AS INTEGER) AS node, "
    else:
        node = f"CAST({'node' if pages else 'NULL'} AS INTEGER) AS page, CAST({n_pages} AS INTEGER) AS n_pages, "
    return f"""
        SELECT '{itype}' AS insight_type, {node}n_entries, {summary} AS summary, {data} AS kpi_data
        FROM (
          SELECT node, count(*) AS n_entries, {sums}, list(e ORDER BY {key}) AS entries,
            list(e ORDER BY {lead} DESC NULLS LAST, {key})[1:3] AS highest, list(e ORDER BY {lead} NULLS LAST, {key})[1:3] AS lowest
          FROM (SELECT *, struct_pack({fields}) AS e, {page if pages else 0} AS node FROM {view}) p
          GROUP BY node) g"""


def _hashed_vec_sql(table: str, id_cols: str, text: str, dim: int) -> str:
    """Normalized hashed term counts, as the default embedding builds them."""
    b = (
        f"list_transform(list_transform(list_filter(string_split_regex(lower({text}), '[^a-z0-9]+'), lambda t: t <> ''), "
        f"lambda t: CASE WHEN length(t) > 3 THEN regexp_replace(t, 's$', '') ELSE t END), "
        f"lambda t: (('0x' || substr(md5(t), 1, 8))::BIGINT) % {dim})"
    )
    counts = f"list_transform(range({dim}), lambda i: CAST(len(list_filter(b, lambda x: x = i)) AS DOUBLE))"
    return (
        f"(SELECT {id_cols}, list_transform(counts, lambda x: CASE WHEN norm > 0 THEN x / norm ELSE 0.0 END) AS v FROM "
        f"(SELECT {id_cols}, counts, sqrt(list_sum(list_transform(counts, lambda y: y * y))) AS norm FROM "
        f"(SELECT {id_cols}, {counts} AS counts FROM (SELECT {id_cols}, {b} AS b FROM {table}) t1) t2) t3)"
    )


def _retrieval_ctes() -> str:
    from ..functions.text import EMBED_DIM
    from .retrieval import CONTEXT_K, NO_ANSWER, PRODUCT_DOC, QUESTIONS, TOP_K, VENDOR_DOC

    qvals = ", ".join(f"({i + 1}, {_sql_text(q)})" for i, q in enumerate(QUESTIONS))
    dist = "round(list_sum(list_transform(list_zip(q.v, d.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), 6)"
    return f"""
dim_product AS (
  SELECT product_id, max(product_name) AS product_name, max(categories) AS categories FROM products_clean GROUP BY product_id
),
dim_vendor AS (SELECT vendor_id, max(vendor_name) AS vendor_name FROM vendors_clean GROUP BY vendor_id),
product_documents AS (
  SELECT 'product:' || p.product_id AS doc_id, 'product' AS kind,
    printf({_sql_text(PRODUCT_DOC)}, coalesce(p.product_name, 'unknown'), coalesce(p.categories, 'unknown'),
           CASE WHEN s.product_id IS NOT NULL THEN 'slow-moving' ELSE 'fast-moving' END) AS text
  FROM dim_product p LEFT JOIN (SELECT DISTINCT product_id FROM agg_slow_moving_products) s ON p.product_id = s.product_id
),
vendor_documents AS (
  SELECT 'vendor:' || v.vendor_id AS doc_id, 'vendor' AS kind,
    printf({_sql_text(VENDOR_DOC)}, coalesce(v.vendor_name, 'unknown'),
           coalesce(CAST(CAST(a.return_rate AS DECIMAL(20,6)) AS VARCHAR), 'unknown')) AS text
  FROM dim_vendor v LEFT JOIN agg_vendor_performance a ON v.vendor_id = a.vendor_id
),
rag_documents AS (SELECT * FROM product_documents UNION ALL SELECT * FROM vendor_documents),
questions AS (SELECT * FROM (VALUES {qvals}) q(question_id, question)),
doc_vec AS {_hashed_vec_sql("rag_documents", "doc_id", "text", EMBED_DIM)},
q_vec AS {_hashed_vec_sql("questions", "question_id", "question", EMBED_DIM)},
rag_topk AS (
  SELECT question_id, doc_id, CAST(rank AS INTEGER) AS rank, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY distance, doc_id) AS rank
    FROM (SELECT q.question_id, d.doc_id, {dist} AS distance FROM q_vec q, doc_vec d) x) y
  WHERE rank <= {TOP_K}
),
rag_context AS (
  SELECT question_id, CAST(context_rank AS INTEGER) AS context_rank, text FROM (
    SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY hit_rank) AS context_rank
    FROM (SELECT h.question_id, d.text, min(h.rank) AS hit_rank FROM rag_topk h JOIN rag_documents d ON h.doc_id = d.doc_id
          GROUP BY h.question_id, d.text) x) y
  WHERE context_rank <= {CONTEXT_K}
),
rag_answer AS (
  SELECT q.question_id, q.question,
    CASE WHEN length(trim(coalesce(a.kept_text, ''))) > 0 THEN a.kept_text ELSE {_sql_text(NO_ANSWER)} END AS answer,
    coalesce(a.docs, '[]') AS retrieved_docs
  FROM questions q LEFT JOIN (
    SELECT c.question_id,
      string_agg(CASE WHEN r.route IS NULL OR contains(lower(c.text), r.route) THEN c.text END, chr(10) ORDER BY c.context_rank) AS kept_text,
      to_json(list(c.text ORDER BY c.context_rank)) AS docs
    FROM rag_context c JOIN (
      SELECT question_id, CASE WHEN contains(lower(question), 'slow-moving') THEN 'slow-moving'
                               WHEN contains(lower(question), 'fast-moving') THEN 'fast-moving' END AS route
      FROM questions) r ON c.question_id = r.question_id
    GROUP BY c.question_id) a ON q.question_id = a.question_id
),
emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
centroids AS (
  SELECT label, list(m ORDER BY pos) AS v FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, unnest(v) AS x, unnest(generate_series(1, len(v))) AS pos FROM emb) e GROUP BY label, pos) c
  GROUP BY label
),
vector_topk AS (
  SELECT label, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) AS rank
    FROM (SELECT q.label, d.vec_id, {dist} AS distance FROM centroids q, emb d) x) y
  WHERE rank <= {TOP_K}
)"""


def _late_bodies() -> dict[str, str]:
    from .fraud import BRIEF_TEMPLATE, PROMPT_TEMPLATE as FRAUD_PROMPT

    fx = _failure_cte()
    brief = f"printf({_sql_text(BRIEF_TEMPLATE)}, customer_id, total_returns, anomaly_score, violated_rules)"
    fprompt = (
        f"printf({_sql_text(FRAUD_PROMPT)}, customer_id, total_returns, CAST(CAST(total_return_value AS DECIMAL(38,4)) AS VARCHAR), "
        f"CAST(CAST(round(return_to_order_ratio, 2) AS DECIMAL(10,2)) AS VARCHAR), anomaly_score, violated_rules)"
    )
    return {
        "return_profile": "SELECT * FROM return_profile",
        "sales_profile": "SELECT * FROM sales_profile",
        "customer_return_profile": "SELECT * FROM customer_return_profile",
        "anomaly_score": "SELECT * FROM anomaly_score",
        "fraud_prompts": f"SELECT customer_id, anomaly_score, {fprompt} AS prompt FROM flagged",
        "flagged_return_customers": f"SELECT customer_id, total_returns, total_return_value, anomaly_score, violated_rules, "
        f"{brief} AS investigation_brief FROM flagged",
        "kpi_revenue": "SELECT * FROM kpi_revenue",
        "kpi_vendor": "SELECT * FROM kpi_vendor",
        "kpi_slow_moving": "SELECT * FROM kpi_slow_moving",
        "ai_insights_kpi": " UNION ALL ".join(_kpi_sql(t, pages, named=False) for t in _KPIS for pages in (False, True)),
        "ai_insight_pages": " UNION ALL ".join(_kpi_sql(t, True) for t in _KPIS),
        "product_documents": "SELECT * FROM product_documents",
        "vendor_documents": "SELECT * FROM vendor_documents",
        "rag_documents": "SELECT * FROM rag_documents",
        "rag_topk": "SELECT * FROM rag_topk",
        "rag_context": "SELECT * FROM rag_context",
        "rag_answer": "SELECT * FROM rag_answer",
        "vector_topk": "SELECT * FROM vector_topk",
        "vector_topk_all": """
            SELECT query_id, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM (
              SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank
              FROM (SELECT q.vec_id AS query_id, d.vec_id,
                      round(list_sum(list_transform(list_zip(q.v, d.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), 6) AS distance
                    FROM emb q, emb d) x) y
            WHERE rank <= 5""",
        "dq_prompts": f"SELECT field_name, issue_type, failed_count, entity_name, prompt FROM {fx}",
        "parse_reply": f"SELECT entity_name, field_name, issue_type, reply, business_impact FROM {fx}",
        "dq_audit_report": f"SELECT entity_name, issue_type, field_name, failed_count, business_impact FROM {fx}",
    }


def oracle_sql() -> dict[str, str]:
    BODIES.update(_late_bodies())
    from . import incremental

    return {k: with_ctes(v) for k, v in BODIES.items()} | incremental.oracle_sql(_CTES)
