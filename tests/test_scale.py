"""Hot keys: one order holding a third of all line rows. With broadcast off
and small skew thresholds (so local mode behaves like a large cluster), the
fact join must split the hot partition and the results stay whole; dedupe
must combine map-side before its shuffle."""

from pyspark.sql import functions as F

from ledgerline.operators.dedupe import latest_by_key
from ledgerline.plans import gold


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_join_splits_hot_order(spark):
    n = 30000
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 5000).cast("string")).alias("order_id"),
            F.col("id").cast("string").alias("product_id"),
            F.lit(1.0).alias("sales"),
            F.lit(1).alias("quantity"),
            F.lit(0.1).alias("profit"),
        )
        orders = spark.range(5000).select(
            F.col("id").cast("string").alias("order_id"),
            F.lit("c").alias("customer_id"),
            F.lit("v").alias("vendor_id"),
            F.lit("r").alias("region"),
            F.lit(None).cast("timestamp_ntz").alias("order_purchase_date"),
        ).unionByName(spark.createDataFrame([("HOT", "c", "v", "r", None)], orders_schema()))
        ft = gold.fact_transactions(orders, lines)
        assert ft.count() == n  # every line kept, none dropped or capped
        agg = ft.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
        rows = agg.filter(F.col("order_id") == "HOT").collect()
        assert rows[0].n == n // 3
        ft.collect()
        plan = _plan(ft)
        assert "SortMergeJoin" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def orders_schema():
    return "order_id string, customer_id string, vendor_id string, region string, order_purchase_date timestamp_ntz"


def test_dedupe_combines_before_shuffle(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    out = latest_by_key(df, ["k"])
    assert out.filter(F.col("k") == "HOT").collect()[0].v == 19998
    plan = out._jdf.queryExecution().executedPlan().toString()
    exch = plan.index("Exchange hashpartitioning")
    assert "partial_max" in plan[exch:]  # partial aggregate sits below (before) the exchange
