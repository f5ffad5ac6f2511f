"""The whole incremental path on the driver's data: testbed entities landed
as regional CSV / JSON files (differing headers), ingested, run through
Silver and Gold as availableNow streams; results equal the batch lineage."""

from conftest import SF_SMALL
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.plans.silver import ENTITIES
from ledgerline.streaming.runner import Layout, Runner
from tools.land_testbed import land_testbed


def _bag(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_streaming_testbed_equals_batch(spark, scratch):
    landing = f"{scratch}/landing"
    land_testbed(spark, SF_SMALL, landing)
    layout = Layout(f"{scratch}/lake")
    r = Runner(spark, layout, checkpoint_root=f"{scratch}/ck")
    r.run(landing)
    lh = Lakehouse.from_testbed(spark, SF_SMALL)
    for e in ENTITIES:
        assert (r.silver_table(e, "clean").count(), r.silver_table(e, "quarantine").count()) == (
            lh.clean(e).count(),
            lh.quarantine(e).count(),
        ), e
    ft_cols = ["order_id", "customer_id", "vendor_id", "product_id", "region", "date_key", "sales_amount", "quantity", "profit"]
    assert _bag(r.table(layout.gold("fact_transactions")), ft_cols) == _bag(lh.fact_transactions, ft_cols)
    fr_cols = ["order_id", "customer_id", "vendor_id", "refund_amount", "return_status", "date_key"]
    assert _bag(r.table(layout.gold("fact_returns")), fr_cols) == _bag(lh.fact_returns, fr_cols)
    for name in ("agg_monthly_revenue", "agg_vendor_performance", "agg_slow_moving_products", "agg_customer_returns"):
        got = r.table(layout.gold(name))
        assert _bag(got, sorted(got.columns)) == _bag(getattr(lh, name), sorted(got.columns)), name
    for name, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"), ("dim_vendor", "vendor_id"), ("dim_date", "date_key")):
        got = r.table(layout.gold(name))
        assert _bag(got, [key]) == _bag(getattr(lh, name), [key]), name
