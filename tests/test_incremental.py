"""Versioned tables and the maintenance of facts, dims and KPIs by deltas."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions.measures import money, money_sum
from ledgerline.operators.dedupe import latest_by_key
from ledgerline.plans import incremental, publish
from ledgerline.sources.versions import VersionedTable
from ledgerline.streaming.ingest import RESCUED, read_new_files
from ledgerline.streaming.maintain import DeltaJoin, KeyedTable, MergedAggregate


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def failing(df):
    """The same rows, but the task that meets the last one fails."""
    return df.withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))


def test_failed_write_keeps_the_old_rows(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t")
    old = spark.range(100).withColumn("x", F.col("id") * 2)
    assert table.replace(old.limit(7)) == 7
    with pytest.raises(PySparkException):
        table.replace(failing(old))
    assert table.read().count() == 7 and VersionedTable(spark, f"{scratch}/t").read().count() == 7
    assert table.replace(old) == 100
    again = VersionedTable(spark, f"{scratch}/t")
    assert (again.read().count(), again.version) == (100, 1)
    again.clear()
    empty = VersionedTable(spark, f"{scratch}/t").read()
    assert empty.count() == 0 and empty.columns == ["id", "x"]


def test_failed_publish_keeps_the_old_rows(spark):
    publish.use_namespace(spark, "versions_test")
    rows = spark.range(100)
    for _ in range(2):
        assert publish.publish_overwrite(rows.limit(5), "kept", comment="five") == 5
    with pytest.raises(PySparkException):
        publish.publish_overwrite(failing(rows), "kept")
    assert spark.table("kept").count() == 5
    insights = spark.createDataFrame([("a", 1, "s", "{}", None)], publish.INSIGHTS_DDL)
    publish.publish_insights(spark, insights, "insights")
    with pytest.raises(PySparkException):
        publish.publish_insights(spark, insights.withColumn("summary", F.raise_error(F.lit("lost")).cast("string")), "insights")
    assert [r["insight_type"] for r in spark.table("insights").collect()] == ["a"]
    publish.empty_table(spark, "kept")
    assert spark.table("kept").count() == 0 and spark.table("kept").columns == ["id"]
    spark.catalog.setCurrentDatabase("default")


def batches(spark, seed, n=4):
    """Two sides in batches; a hot key, late matches, repeated rows, NULL keys."""
    rng = random.Random(seed)
    key = lambda: None if rng.random() < 0.1 else "hot" if rng.random() < 0.3 else f"k{rng.randrange(20)}"
    side = lambda name, size: spark.createDataFrame([(key(), rng.choice(["a", "b", None]), rng.randrange(5)) for _ in range(size)], f"key string, {name}_x string, {name}_y int")
    return [(side("l", rng.choice([0, 15, 30])), side("r", rng.choice([0, 12, 25]))) for _ in range(n)]


def join(left, right):
    return left.join(right, "key")


def test_delta_join_equals_the_join_of_all(spark, scratch):
    drops = batches(spark, 1, 5)
    facts = DeltaJoin(VersionedTable(spark, f"{scratch}/f", 4), "key", join)
    left = right = None
    for n, (a, b) in enumerate(drops):
        added = facts.apply(a, b, n)
        again = DeltaJoin(VersionedTable(spark, f"{scratch}/f", 4), "key", join).apply(a, b, n)  # the batch is run again after a restart
        assert (added is None) == (again is None) and (added is None or bag(added) == bag(again))
        left, right = (a, b) if left is None else (left.unionByName(a), right.unionByName(b))
        want = bag(join(left, right))
        rows = facts.table.read()
        assert (bag(rows) if rows is not None else []) == want
    assert "_left" not in str(facts.table.read().columns)


def test_delta_join_failing_half_way_adds_nothing(spark, scratch):
    (a, b), (c, d) = batches(spark, 2, 2)
    a, b, c, d = (x.unionByName(x) if x.count() else spark.createDataFrame([("hot", "a", 1)], x.schema) for x in (a, b, c, d))
    facts = DeltaJoin(VersionedTable(spark, f"{scratch}/f", 3), "key", join)
    facts.apply(a, b, 0)
    before = bag(facts.table.read())
    with pytest.raises(PySparkException):
        facts.apply(c, d.withColumn("r_x", F.raise_error(F.lit("lost")).cast("string")), 1)
    fresh = DeltaJoin(VersionedTable(spark, f"{scratch}/f", 3), "key", join)
    assert bag(fresh.table.read()) == before
    fresh.apply(c, d, 1)
    assert bag(fresh.table.read()) == bag(join(a.unionByName(c), b.unionByName(d)))


def test_upsert_rewrites_only_touched_buckets(spark, scratch):
    rows = spark.createDataFrame([(f"k{i % 40}", i, f"v{i}") for i in range(100)], "key string, at long, value string")
    dim = KeyedTable(VersionedTable(spark, f"{scratch}/d", 8), ["key"], ["at"])
    dim.upsert(rows, 0)
    assert bag(dim.read().select(*rows.columns)) == bag(latest_by_key(rows, ["key"], ["at"]))
    was = {e.bucket: e.folder for e in dim.table.entries}
    late = spark.createDataFrame([("k1", 1000, "new"), ("k2", -1, "too old")], rows.schema)
    dim.upsert(late, 1)
    dim.upsert(late, 1)
    now = {e.bucket: e.folder for e in dim.table.entries}
    assert 1 <= sum(was[b] != f for b, f in now.items()) <= 2 and set(was) == set(now)
    assert bag(dim.read().select(*rows.columns)) == bag(latest_by_key(rows.unionByName(late), ["key"], ["at"]))


def test_merged_aggregate_equals_the_aggregate_of_all(spark, scratch):
    rng = random.Random(5)
    kpi = lambda: MergedAggregate(VersionedTable(spark, f"{scratch}/k", 4), ["region", "month"], {"total": money("amount")}, "order_id", {"month": F.upper("m")})
    everything = None
    for n in range(4):
        rows = [(rng.choice(["E", "W", None]), rng.choice(["x", None]), f"o{rng.randrange(30)}", rng.choice([0.1, 0.2, 1e12, None])) for _ in range(40)]
        delta = spark.createDataFrame(rows, "region string, m string, order_id string, amount double")
        if n == 2:
            kpi().apply(None, n)
            continue
        kpi().apply(delta, n)
        kpi().apply(delta, n)  # run again: counted once
        everything = delta if everything is None else everything.unionByName(delta)
        want = everything.groupBy("region", F.upper("m").alias("month")).agg(F.count(F.lit(1)), money_sum("amount"), F.count_distinct("order_id"))
        got = kpi().read().select("region", "month", "n_rows", F.col("total").cast("double"), "n_distinct")
        assert bag(got) == bag(want)


def test_appended_parts_are_compacted(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/c", 2)
    for n in range(5):
        table.commit(table.entries + table.write(spark.range(n * 10, n * 10 + 10), "side", ["id"]), n)
    table.compact("side", most=3)
    assert len({e.folder for e in table.entries}) == 1 and table.batch == 4
    assert sorted(r["id"] for r in VersionedTable(spark, f"{scratch}/c").read("side").collect()) == list(range(50))


def test_lake_reads_follow_the_delta(spark):
    """After three drops, a fourth run with nothing new changes no version."""
    from conftest import SF_SMALL

    runner = incremental.lake(spark, SF_SMALL)
    names = ("dim_customer", "fact_transactions", "fact_returns", "partials/monthly_revenue")
    was = {n: runner.versioned(runner.layout.gold(n)).version for n in names}
    runner.run(runner.layout.root.replace("/lake", "/landing"), specs=incremental.SPECS)
    assert {n: runner.versioned(runner.layout.gold(n)).version for n in names} == was
    facts = runner.versioned(runner.layout.gold("fact_transactions"))
    assert {e.part for e in facts.entries} == {"left", "right", "rows"}


def test_catalog_names_have_comments(spark):
    from conftest import SF_SMALL

    incremental.QUERIES["stream_sql_tables"](spark, SF_SMALL).collect()
    for name in ("bronze_orders", "silver_orders", "quarantine_orders", "dim_customer", "agg_monthly_revenue"):
        assert spark.catalog.getTable(f"ledgerline_lake.{name}").description


def test_rows_of_a_drop_are_chosen_before_they_are_multiplied(spark):
    """No row is copied to be filtered out again, and every arrival is landed once in its drop."""
    raw = incremental.raw_entities(incremental.Tables(spark, "/root/testdata/sf0.001"))
    counts = [0, 0]
    for drop in range(1, incremental.DROPS + 1):
        rows = incremental.arrivals(raw, drop)
        assert all("Generate" not in df._jdf.queryExecution().optimizedPlan().toString() for df in rows.values())
        counts[0] += rows["Region 1/orders"].count()
        counts[1] += rows["vendors"].count()
    keys = [int(r[0]) for r in raw["orders"].select("Order ID").collect()]
    assert counts[0] == sum(2 if k % incremental.REPEATED_ORDER == 0 and k % 3 < 2 else 1 for k in keys)
    ids = [r[0] for r in raw["vendors"].select("VendorID").collect()]
    assert counts[1] == sum(2 if i is not None and int(i) % 4 == 0 else 1 for i in ids)


def test_larger_new_side_is_joined_once(spark, scratch):
    """of two batches, every new row of the larger side meets the other side in one join only."""
    handed = []

    def recording(left, right):
        handed.append((left.count(), right.count()))
        return join(left, right)

    few = [spark.createDataFrame([("hot", f"l{n}", n)], "key string, l_x string, l_y int") for n in range(2)]
    many = [spark.createDataFrame([("hot", f"r{n}", i) for i in range(10)], "key string, r_x string, r_y int") for n in range(2)]
    facts = DeltaJoin(VersionedTable(spark, f"{scratch}/f", 4), "key", recording)
    for n in range(2):
        handed.clear()
        facts.apply(few[n], many[n], n)
        assert sum(r for _, r in handed) == 10 * (n + 1)
    assert bag(facts.table.read()) == bag(join(few[0].unionByName(few[1]), many[0].unionByName(many[1])))
    other = DeltaJoin(VersionedTable(spark, f"{scratch}/g", 4), "key", lambda right, left: recording(left, right))
    for n in range(2):  # the larger side on the left
        handed.clear()
        other.apply(many[n], few[n], n)
        assert sum(r for _, r in handed) == 10 * (n + 1)
    assert bag(other.table.read().select(facts.table.read().columns)) == bag(facts.table.read())


def test_few_buckets_are_written_without_a_shuffle(spark, scratch):
    """rows are only brought together by bucket where a task cannot keep a file of each open."""
    rows = spark.range(1000).withColumn("x", F.col("id") % 7)
    for buckets, shuffled in ((8, False), (64, True)):
        table = VersionedTable(spark, f"{scratch}/{buckets}", buckets)
        plan = table._bucketed(rows, ["id"])._jdf.queryExecution().optimizedPlan().toString()
        assert ("Rebalance" in plan) == shuffled
        table.commit(table.write(rows, keys=["id"]), 0)
        assert len({e.bucket for e in table.entries}) == buckets and bag(table.read()) == bag(rows)
        assert bag(table.read(buckets={e.bucket for e in table.entries if e.bucket < 3}).select("id")) == bag(table._bucketed(rows, ["id"]).where("bucket < 3").select("id"))


def test_landed_files_are_compressed_and_whole(spark, scratch):
    """The files of a drop are landed compressed, and Bronze reads every row of them."""
    import glob

    raw = incremental.raw_entities(incremental.Tables(spark, "/root/testdata/sf0.001"))
    incremental.land(raw, f"{scratch}/landing", 2)
    for name, rows in incremental.arrivals(raw, 2).items():
        fmt = "json" if name in ("returns", "products") else "csv"
        files = sorted(glob.glob(f"{scratch}/landing/{name}_2.{fmt}/part-*"))
        assert files and all(f.endswith(".gz") for f in files)
        assert read_new_files(spark, files, fmt).drop("source_file", "ingestion_timestamp", RESCUED).count() == rows.count()
