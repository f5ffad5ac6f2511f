"""The four consumer jobs over the tables the runner writes: each reads
Silver / Gold from a ``Layout``, builds its output as one DataFrame plan and
publishes it as a catalog table.

    runner = Runner(spark, Layout(root)); runner.run(landing)
    dq_audit_job(spark, layout); return_abuse_job(spark, layout)
    insights_job(spark, layout); question_answer_job(spark, layout, questions)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import EmbedModel
from ..operators.generate import TextModel
from ..operators.quality import STATUS
from ..sources.tables import stage
from ..streaming.runner import Layout, Runner
from . import dq_report, fraud, insights, publish, retrieval
from .silver import ENTITIES


def _gold(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return Runner(spark, layout).gold_table(name)


def quarantine_tables(spark: SparkSession, layout: Layout, entities: Sequence[str] = ENTITIES) -> dict[str, DataFrame]:
    return {
        e: spark.read.parquet(layout.silver(e)).filter(F.col(STATUS) == "quarantine").drop(STATUS, "source_file", "ingestion_timestamp")
        for e in entities
    }


def dq_audit_job(spark: SparkSession, layout: Layout, table: str = "dq_audit_report", model: TextModel | None = None) -> int:
    """Failed checks of every entity with a business-impact explanation (UC1)."""
    return publish.publish_overwrite(dq_report.audit_report(quarantine_tables(spark, layout), model), table)


def return_abuse_job(
    spark: SparkSession, layout: Layout, table: str = "flagged_return_customers", model: TextModel | None = None, as_of: str | None = None
) -> int:
    """Score every customer with returns, publish the flagged ones with briefs (UC2)."""
    fr = _gold(spark, layout, "fact_returns")
    ft = _gold(spark, layout, "fact_transactions")
    profile = fraud.customer_return_profile(fraud.return_profile(fr, as_of), fraud.sales_profile(ft))
    flagged = fraud.flagged(fraud.anomaly_score(profile))
    return publish.publish_overwrite(fraud.flagged_return_customers(flagged, model), table)


def insights_job(spark: SparkSession, layout: Layout, table: str = "ai_business_insights", model: TextModel | None = None) -> None:
    """KPI views → summary trees → insights table, with all their nodes in ``{table}_tree`` (UC4)."""
    views = {
        "revenue_performance": insights.kpi_revenue(_gold(spark, layout, "agg_monthly_revenue")),
        "vendor_return_rate": insights.kpi_vendor(_gold(spark, layout, "agg_vendor_performance")),
        "slow_moving_inventory": insights.kpi_slow_moving(_gold(spark, layout, "agg_slow_moving_products")),
    }
    publish.register_views({"revenue_kpi": views["revenue_performance"], "vendor_kpi": views["vendor_return_rate"], "slow_kpi": views["slow_moving_inventory"]})
    publish.publish_overwrite(insights.summary_tree({name: stage(v, name) for name, v in views.items()}, model), f"{table}_tree")
    publish.publish_insights(spark, insights.insights(spark.table(f"{table}_tree")), table)


def question_answer_job(
    spark: SparkSession,
    layout: Layout,
    questions: Sequence[str] = retrieval.QUESTIONS,
    table: str = "rag_query_history",
    embed_model: EmbedModel | None = None,
) -> DataFrame:
    """Answer a batch of questions from documents over the whole product and
    vendor dimensions and append them to the query history (UC3)."""
    products = retrieval.product_documents(_gold(spark, layout, "dim_product"), _gold(spark, layout, "agg_slow_moving_products"))
    vendors = retrieval.vendor_documents(_gold(spark, layout, "dim_vendor"), _gold(spark, layout, "agg_vendor_performance"))
    docs = stage(retrieval.rag_documents(products, vendors), "rag_documents")
    qs = retrieval.questions_frame(spark, questions)
    hits = retrieval.top_k(docs, qs, model=embed_model)
    answers = retrieval.answer(qs, retrieval.context(hits, docs, broadcast_hits=retrieval.questions_bounded(qs)))
    answers = stage(answers, "rag_answers")  # logged and returned: computed once
    publish.log_answers(answers, table)
    return answers
