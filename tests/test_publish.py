"""Table lifecycle: namespace, overwrite with observed count, DDL + insert
overwrite, append log, temp views, one-row model call."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.plans import catalog, dq_report, publish
from ledgerline.plans.silver import ENTITIES
from ledgerline.plans.lakehouse import Lakehouse


def test_publish_tables(spark):
    publish.use_namespace(spark, "gold_test")
    lh = Lakehouse.from_testbed(spark, SF_SMALL)
    report = dq_report.audit_report({e: lh.quarantine(e) for e in ENTITIES})
    n = publish.publish_overwrite(report, "dq_audit_report", comment="Failed checks with impact text")
    assert n == spark.table("dq_audit_report").count() > 0
    assert n == publish.publish_overwrite(report, "dq_audit_report")  # overwrite, not append

    ins = catalog.QUERIES["ai_insights_kpi"](spark, SF_SMALL).withColumn("generated_at", F.current_timestamp())
    for _ in range(2):
        publish.publish_insights(spark, ins, "ai_business_insights")
    assert spark.table("ai_business_insights").count() == ins.count()

    ans = catalog.QUERIES["rag_answer"](spark, SF_SMALL)
    publish.log_answers(ans, "rag_query_history")
    publish.log_answers(ans, "rag_query_history")
    assert spark.table("rag_query_history").count() == 2 * ans.count()

    publish.register_views({"revenue_kpi": catalog.QUERIES["kpi_revenue"](spark, SF_SMALL)})
    assert spark.sql("SELECT count(*) FROM revenue_kpi").collect()[0][0] == 5
    spark.catalog.setCurrentDatabase("default")


def test_ask_once(spark):
    r = publish.ask_once(spark, "Explain revenue trends in 3 lines", model=lambda s: s.str.upper()).collect()
    assert len(r) == 1 and r[0].reply == "EXPLAIN REVENUE TRENDS IN 3 LINES"


def test_attach_stored_explanations(spark):
    counts = spark.createDataFrame([("t", "missing a", "_dq_a", 2)], "entity_name string, issue_type string, field_name string, failed_count long")
    stored = spark.createDataFrame([("t", "missing a", "_dq_a", "Impact.")], "entity_name string, issue_type string, field_name string, business_impact string")
    out = dq_report.attach_explanations(counts, stored).collect()
    assert out[0].business_impact == "Impact."


def test_consumer_jobs_over_runner_tables(spark, scratch):
    """The four consumer jobs read what the runner wrote and publish tables."""
    from ledgerline.plans import jobs
    from ledgerline.streaming.runner import Layout, Runner
    from test_streaming import land

    landing = f"{scratch}/landing"
    land(landing)
    layout = Layout(f"{scratch}/lake")
    Runner(spark, layout, checkpoint_root=f"{scratch}/ck").run(landing)
    publish.use_namespace(spark, "consumers_test")
    assert jobs.dq_audit_job(spark, layout) > 0
    n_flagged = jobs.return_abuse_job(spark, layout)
    assert n_flagged == spark.table("flagged_return_customers").count()
    jobs.insights_job(spark, layout)
    assert spark.table("ai_business_insights").select("insight_type").distinct().count() == 3
    ans = jobs.question_answer_job(spark, layout, ["Which products are slow-moving?"])
    assert ans.count() == 1 and spark.table("rag_query_history").count() == 1
    spark.catalog.setCurrentDatabase("default")
