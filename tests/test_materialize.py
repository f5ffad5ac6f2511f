"""Bucketed Silver tables: Gold over them equals Gold over raw frames, and
the fact join reads co-located buckets without shuffling either side."""

from conftest import SF_SMALL
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.plans.materialize import TableLakehouse, write_silver_tables


def _bag(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_bucketed_silver_fact_join_has_no_shuffle(spark):
    lh = Lakehouse.from_testbed(spark, SF_SMALL)
    write_silver_tables(lh, spark, "silver_bucketed_test", buckets=4)
    tl = TableLakehouse(spark, "silver_bucketed_test")
    cols = ["order_id", "customer_id", "vendor_id", "product_id", "region", "date_key", "sales_amount", "quantity"]
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")  # cluster-like: no side is small enough to broadcast
        ft = tl.fact_transactions
        assert _bag(ft, cols) == _bag(lh.fact_transactions, cols)
        plan = ft._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(order_id" not in plan
        fr_cols = ["order_id", "customer_id", "vendor_id", "refund_amount", "return_status"]
        assert _bag(tl.fact_returns, fr_cols) == _bag(lh.fact_returns, fr_cols)
        assert tl.quarantine("orders").count() == lh.quarantine("orders").count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
