"""Registered queries: name → (spark, sf_dir) → DataFrame.

Each query builds the whole lineage from the driver tables (testbed mapping →
Silver → Gold → consumer), so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.columns import ALIASES, normalize_columns, resolve_alias
from ..operators import quality as Q
from ..operators.knn import exact_knn
from ..sources.tables import Tables, stage
from ..sources.testbed import raw_entities
from . import dq_report, fraud, incremental, insights, retrieval
from .gold import ORDER_COLUMNS
from .lakehouse import Lakehouse
from .silver import ENTITIES, SilverOptions

Query = Callable[[SparkSession, str], DataFrame]


# Staging rule: a query writes once (under spark.checkpoint.dir) whatever it
# reads more than once, and of it only the columns it reads; clean orders feed both facts.
BOTH_FACTS_STAGE = {"orders": ORDER_COLUMNS}
GOLD_STAGE = {"agg_vendor_performance": BOTH_FACTS_STAGE}


def _gold(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Lakehouse.from_testbed(spark, sf_dir, stage=GOLD_STAGE.get(name, ())), name)

    run.__name__ = name
    return run


GOLD = [
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
]

QUERIES: dict[str, Query] = {name: _gold(name) for name in GOLD}


def _raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return normalize_columns(raw_entities(Tables(spark, sf_dir))[entity])


def _split(entity: str, side: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lh = Lakehouse.from_testbed(spark, sf_dir)
        return lh.clean(entity) if side == "clean" else lh.quarantine(entity)

    run.__name__ = f"{side}_{entity}"
    return run


for _e in ENTITIES:
    QUERIES[f"clean_{_e}"] = _split(_e, "clean")
    QUERIES[f"quarantine_{_e}"] = _split(_e, "quarantine")


def scan_orders_header(spark, sf_dir):
    """Batch read of a Bronze-shaped table with its headers normalized."""
    return _raw(spark, sf_dir, "orders")


def normalize_customers(spark, sf_dir):
    """Regional header spellings snake-cased."""
    return _raw(spark, sf_dir, "customers")


def harmonize_alias(spark, sf_dir):
    """Alias resolution per row vs the first-existing-column rule."""
    df = _raw(spark, sf_dir, "customers")
    spec = ALIASES["customers"]
    return df.select(
        resolve_alias(df, spec["customer_id"]).alias("customer_id"),
        resolve_alias(df, spec["customer_id"], "first_column").alias("customer_id_first_column"),
        resolve_alias(df, spec["customer_email"]).alias("customer_email"),
        resolve_alias(df, spec["customer_name"]).alias("customer_name"),
    )


def segment_rule(spark, sf_dir):
    """Segment code → label and the IN-list rule, counted per raw value (Q1, P10)."""
    df = _raw(spark, sf_dir, "customers")
    seg = C.segment_label(F.col("segment"))
    return df.groupBy(
        F.col("segment").alias("segment_raw"),
        seg.alias("segment"),
        F.coalesce(seg.isin(*C.VALID_SEGMENTS), F.lit(False)).alias("segment_ok"),
    ).agg(F.count(F.lit(1)).alias("n"))


def ship_mode_norm(spark, sf_dir):
    df = _raw(spark, sf_dir, "orders")
    return df.groupBy(F.col("ship_mode").alias("ship_mode_raw"), C.ship_mode_label(F.col("ship_mode")).alias("ship_mode")).agg(
        F.count(F.lit(1)).alias("n")
    )


def return_status_norm(spark, sf_dir):
    df = _raw(spark, sf_dir, "returns")
    up = F.upper(resolve_alias(df, ALIASES["returns"]["return_status"]))
    return df.groupBy(
        F.col("status").alias("status_text"), up.alias("return_status_raw"), C.return_status_label(up).alias("return_status")
    ).agg(F.count(F.lit(1)).alias("n"))


def discount_percent(spark, sf_dir):
    """Percent-aware discount parse next to the as-written parity rule."""
    df = _raw(spark, sf_dir, "transactions")
    return df.select(
        F.col("order_id"),
        F.col("productid").alias("product_id"),
        F.col("discount").alias("discount_text"),
        C.percent_to_fraction(F.col("discount")).alias("discount"),
        C.percent_to_fraction(F.col("discount"), "as_written").alias("discount_as_written"),
    )


def refund_clean(spark, sf_dir):
    """Currency text → amount; unparseable → NULL (Q5)."""
    df = _raw(spark, sf_dir, "returns")
    amt = C.currency_to_double(F.col("amount"))
    return df.select(
        F.col("orderid").alias("order_id"),
        F.col("amount").contains("$").alias("had_symbol"),
        amt.alias("refund_amount"),
    )


def order_date_parse(spark, sf_dir):
    df = _raw(spark, sf_dir, "orders")
    return df.select(
        "order_id",
        F.col("order_purchase_date").alias("order_purchase_date_text"),
        C.parse_timestamp(F.col("order_purchase_date")).alias("order_purchase_date"),
    )


def return_date_parse(spark, sf_dir):
    df = _raw(spark, sf_dir, "returns")
    return df.select(
        F.col("orderid").alias("order_id"),
        F.col("return_date").alias("return_date_text"),
        C.parse_date(F.col("return_date")).alias("return_date"),
    )


def upc_digits(spark, sf_dir):
    df = _raw(spark, sf_dir, "products")
    return df.select(F.col("productid").alias("product_id"), F.col("upc").alias("upc_text"), C.upc_digits(F.col("upc")).alias("upc"))


def vendor_initcap(spark, sf_dir):
    df = _raw(spark, sf_dir, "vendors")
    return df.select(
        F.col("vendorid").alias("vendor_id"), F.col("vendor_name").alias("vendor_name_raw"), C.title_case(F.col("vendor_name")).alias("vendor_name")
    )


def orders_region_freeze(spark, sf_dir):
    """Region frozen on the order by the left join to clean customers."""
    b = Lakehouse.from_testbed(spark, sf_dir).orders_base
    return b.select("order_id", "customer_id", "region", "_dq_region", "_is_valid", "_dq_reason")


def split_accounting(spark, sf_dir):
    """Input = clean + quarantine for all six entities (Q17 invariant)."""
    lh = Lakehouse.from_testbed(spark, sf_dir)
    return reduce(DataFrame.unionByName, [Q.split_accounting(lh.base(e), e) for e in ENTITIES])


def split_accounting_parity(spark, sf_dir):
    """The reference's three-valued rules: rows whose rule is NULL land in
    neither table (D1), counted as unassigned."""
    lh = Lakehouse.from_testbed(spark, sf_dir, options=SilverOptions(null_policy="drop"))
    return reduce(DataFrame.unionByName, [Q.split_accounting(lh.base(e), e) for e in ENTITIES])


def dim_date_parity(spark, sf_dir):
    """The reference's date dimension: distinct order timestamps and return
    dates, so keys repeat and a NULL row appears (D14)."""
    from . import gold

    lh = Lakehouse.from_testbed(spark, sf_dir)
    return gold.dim_date(lh.clean("orders"), lh.clean("returns"), grain="timestamp")


def _quarantines(spark, sf_dir):
    lh = Lakehouse.from_testbed(spark, sf_dir)
    return {e: lh.quarantine(e) for e in ENTITIES}


def dq_unpivot(spark, sf_dir):
    """One row per (customer, check)."""
    b = Lakehouse.from_testbed(spark, sf_dir).customers_base
    return Q.dq_unpivot(b, ["customer_id", "_dq_reason"])


def dq_failure_counts(spark, sf_dir):
    return dq_report.failure_report(_quarantines(spark, sf_dir))


def dq_failure_counts_per_rule(spark, sf_dir):
    """Every failed check under its own reason, not the row's first one (Q18)."""
    return dq_report.failure_report(_quarantines(spark, sf_dir), per_rule_reason=True)


def dq_prompts(spark, sf_dir):
    return dq_report.dq_prompts(dq_report.failure_report(_quarantines(spark, sf_dir)))


def parse_reply(spark, sf_dir):
    """Replies for every failure row parsed back to ``business_impact`` (M5)."""
    return dq_report.explain(dq_report.failure_report(_quarantines(spark, sf_dir))).select(
        "entity_name", "field_name", "issue_type", "reply", "business_impact"
    )


def dq_audit_report(spark, sf_dir):
    return dq_report.audit_report(_quarantines(spark, sf_dir), stamp=False)


for _f in (
    scan_orders_header,
    normalize_customers,
    harmonize_alias,
    segment_rule,
    ship_mode_norm,
    return_status_norm,
    discount_percent,
    refund_clean,
    order_date_parse,
    return_date_parse,
    upc_digits,
    vendor_initcap,
    orders_region_freeze,
    split_accounting,
    split_accounting_parity,
    dim_date_parity,
    dq_unpivot,
    dq_failure_counts,
    dq_failure_counts_per_rule,
    dq_prompts,
    parse_reply,
    dq_audit_report,
):
    QUERIES[_f.__name__] = _f


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# ---- UC2: return-abuse scoring --------------------------------------------
# fact_returns feeds both the profile and its as-of date; orders feed both facts
SCORING_STAGE = {**BOTH_FACTS_STAGE, "fact_returns": ["customer_id", "refund_amount", "date"]}


def _scored(spark, sf_dir):
    lh = Lakehouse.from_testbed(spark, sf_dir, stage=SCORING_STAGE)
    prof = fraud.customer_return_profile(fraud.return_profile(lh.fact_returns), fraud.sales_profile(lh.fact_transactions))
    return fraud.anomaly_score(prof)


def return_profile(spark, sf_dir):
    return fraud.return_profile(Lakehouse.from_testbed(spark, sf_dir, stage=SCORING_STAGE).fact_returns)


def sales_profile(spark, sf_dir):
    return fraud.sales_profile(Lakehouse.from_testbed(spark, sf_dir).fact_transactions)


def customer_return_profile(spark, sf_dir):
    lh = Lakehouse.from_testbed(spark, sf_dir, stage=SCORING_STAGE)
    return fraud.customer_return_profile(fraud.return_profile(lh.fact_returns), fraud.sales_profile(lh.fact_transactions))


def anomaly_score(spark, sf_dir):
    return _scored(spark, sf_dir)


def fraud_prompts(spark, sf_dir):
    return fraud.fraud_prompts(fraud.flagged(_scored(spark, sf_dir))).select("customer_id", "anomaly_score", "prompt")


def flagged_return_customers(spark, sf_dir):
    return fraud.flagged_return_customers(fraud.flagged(_scored(spark, sf_dir)), stamp=False)


# ---- UC4: KPI views and insights ------------------------------------------
def _kpi_views(spark, sf_dir, stage=()):
    lh = Lakehouse.from_testbed(spark, sf_dir, stage=stage)
    return {
        "revenue_performance": insights.kpi_revenue(lh.agg_monthly_revenue),
        "vendor_return_rate": insights.kpi_vendor(lh.agg_vendor_performance),
        "slow_moving_inventory": insights.kpi_slow_moving(lh.agg_slow_moving_products),
    }


def kpi_revenue(spark, sf_dir):
    return _kpi_views(spark, sf_dir)["revenue_performance"]


def kpi_vendor(spark, sf_dir):
    return _kpi_views(spark, sf_dir, stage=BOTH_FACTS_STAGE)["vendor_return_rate"]


def kpi_slow_moving(spark, sf_dir):
    return _kpi_views(spark, sf_dir)["slow_moving_inventory"]


def _insight_tree(spark, sf_dir):
    # the three views read both facts, and each view is read twice (its count and
    # its pages): facts and the small views are written once
    sold = ["order_id", "vendor_id", "product_id", "region", "date", "sales_amount", "quantity"]
    views = _kpi_views(spark, sf_dir, stage={**BOTH_FACTS_STAGE, "fact_transactions": sold, "fact_returns": ["vendor_id"]})
    return insights.summary_tree({name: stage(v, name) for name, v in views.items()})


def ai_insights_kpi(spark, sf_dir):
    """The insight of each KPI view and the pages with all its entries, as JSON, and their summaries."""
    return insights.insights_whole(_insight_tree(spark, sf_dir))


def ai_insight_pages(spark, sf_dir):
    """The pages below the insights: the whole entry lists and their summaries."""
    return _insight_tree(spark, sf_dir).where("level = 0").select("insight_type", "node", "n_entries", "summary", "kpi_data")


for _f in (
    return_profile,
    sales_profile,
    customer_return_profile,
    anomaly_score,
    fraud_prompts,
    flagged_return_customers,
    kpi_revenue,
    kpi_vendor,
    kpi_slow_moving,
    ai_insights_kpi,
    ai_insight_pages,
):
    QUERIES[_f.__name__] = _f


# ---- UC3: documents, retrieval, grounded answers --------------------------
def _docs(spark, sf_dir, stage=()):
    lh = Lakehouse.from_testbed(spark, sf_dir, stage=stage)
    return (
        retrieval.product_documents(lh.dim_product, lh.agg_slow_moving_products),
        retrieval.vendor_documents(lh.dim_vendor, lh.agg_vendor_performance),
    )


def product_documents(spark, sf_dir):
    return _docs(spark, sf_dir)[0]


def vendor_documents(spark, sf_dir):
    return _docs(spark, sf_dir, stage=BOTH_FACTS_STAGE)[1]


# documents read fact_transactions twice (slow movers, vendor rates)
RAG_STAGE = {**BOTH_FACTS_STAGE, "fact_transactions": ["order_id", "vendor_id", "product_id", "region", "quantity"]}


def rag_documents(spark, sf_dir):
    return retrieval.rag_documents(*_docs(spark, sf_dir, stage=RAG_STAGE))


def _rag(spark, sf_dir):
    # the corpus (one row per product / vendor) is scanned by the search and
    # joined back for text: written once instead of recomputed from the facts
    docs = stage(retrieval.rag_documents(*_docs(spark, sf_dir, stage=RAG_STAGE)), "rag_documents")
    qs = retrieval.questions_frame(spark)
    return docs, qs, retrieval.top_k(docs, qs), retrieval.questions_bounded(qs)


def rag_topk(spark, sf_dir):
    """Five nearest documents per demo question over all product and vendor
    documents (R2–R4)."""
    return _rag(spark, sf_dir)[2]


def rag_context(spark, sf_dir):
    docs, _, hits, bounded = _rag(spark, sf_dir)
    return retrieval.context(hits, docs, broadcast_hits=bounded)


def rag_answer(spark, sf_dir):
    docs, qs, hits, bounded = _rag(spark, sf_dir)
    return retrieval.answer(qs, retrieval.context(hits, docs, broadcast_hits=bounded))


def vector_topk(spark, sf_dir):
    """Exact kNN over the whole vector table; one query per label = the
    label's centroid, computed by Spark from the same table (R4)."""
    vecs = Tables(spark, sf_dir).read("embeddings", ["vec_id", "embedding", "label"])
    cents = retrieval.label_centroids(vecs)
    return exact_knn(vecs, cents, retrieval.TOP_K, corpus_id="vec_id", corpus_vec="embedding", query_id="label", query_vec="centroid")


def vector_topk_all(spark, sf_dir):
    """Every vector as a query against all of them (R4): one scan of the table."""
    vecs = Tables(spark, sf_dir).read("embeddings", ["vec_id", "embedding"])
    asked = vecs.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return exact_knn(vecs, asked, retrieval.TOP_K, corpus_id="vec_id", corpus_vec="embedding", query_id="query_id", query_vec="query")


for _f in (product_documents, vendor_documents, rag_documents, rag_topk, rag_context, rag_answer, vector_topk, vector_topk_all):
    QUERIES[_f.__name__] = _f

QUERIES |= incremental.QUERIES
