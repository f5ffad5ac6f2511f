"""Run the lakehouse incrementally: availableNow streaming queries in
dependency order; Gold and the KPIs follow the new rows only (K1–K13, T1–T8).

* Silver: each Bronze table is read as a stream, standardized and checked,
  and written ONCE to ``silver/{entity}`` partitioned by ``_dq_status``
  (clean / quarantine). The file sink's commit log makes it exactly-once
  and a reader prunes to one status by partition.
* Orders join the clean customers as a static snapshot taken when the
  orders query starts: region is frozen at processing time (J1, T4, D7).
* Gold: streams over the clean Silver rows hand their micro-batches to
  ``maintain``: dims are merged by key (T6), facts joined by deltas without join
  state (T5), KPIs added up from the new facts (T8), ``dim_date`` from the
  union of orders and returns (T7). Their tables are versioned: a failed write
  leaves the rows of before in force. A table and its stream's checkpoint belong together.
* Every stream takes a bounded number of files per micro-batch.

Checkpoints live under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.measures import money
from ..operators.quality import STATUS, with_status
from ..plans import gold, silver
from ..session import ensure_checkpoint_dir
from ..sources.versions import COMPRESSION, VersionedTable, absent
from .ingest import DEFAULT_SPECS, IngestSpec, read_bronze, start_ingest
from .maintain import DeltaJoin, KeyedTable, MergedAggregate

FILES_PER_BATCH = 1000
BUCKETS = 8


@dataclass(frozen=True)
class Layout:
    """Where each layer lives (the reference's catalog.schema names)."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root.rstrip('/')}/bronze"

    def silver(self, entity: str) -> str:
        return f"{self.root.rstrip('/')}/silver/{entity}"

    def gold(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/gold/{name}"


def finish(queries: list[StreamingQuery]) -> None:
    """Waits for all of them; the first failure is raised once none runs any more."""
    failed = None
    for q in queries:
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001 — raised below
            failed = failed or e
    if failed:
        raise failed


def _monthly_revenue(months: DataFrame) -> DataFrame:
    return months.select("region", "month", F.col("total_sales").cast("double").alias("total_sales"), F.col("n_distinct").alias("order_count"))


def _customer_returns(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("n_rows").alias("return_count"), F.col("total_refund_amount").cast("double").alias("total_refund_amount"))


def _vendor_performance(orders: DataFrame, returns: DataFrame | None) -> DataFrame:
    sold = orders.select("vendor_id", F.col("n_distinct").alias("total_orders"))
    back = returns.select("vendor_id", F.col("n_rows").alias("total_returns")) if returns is not None else sold.select("vendor_id", F.lit(None).cast("long").alias("total_returns"))
    return gold.vendor_rates(sold, back)


def _slow_moving_products(units: DataFrame) -> DataFrame:
    return units.select("product_id", "region", "total_quantity_sold").where(F.col("total_quantity_sold") < gold.SLOW_MOVING_THRESHOLD)


# KPI table → the stored partials it is read from, and how
KPI_VIEWS: dict[str, tuple[list[str], Callable[..., DataFrame]]] = {
    "agg_monthly_revenue": (["monthly_revenue"], _monthly_revenue),
    "agg_customer_returns": (["customer_returns"], _customer_returns),
    "agg_vendor_performance": (["vendor_orders", "vendor_returns"], _vendor_performance),
    "agg_slow_moving_products": (["product_units"], _slow_moving_products),
}


class Runner:
    def __init__(
        self,
        spark: SparkSession,
        layout: Layout,
        options: silver.SilverOptions = silver.SilverOptions(),
        checkpoint_root: str | None = None,
        files_per_batch: int = FILES_PER_BATCH,
        buckets: int = BUCKETS,
    ):
        """``buckets`` of a Gold table's keys, fixed when the table is first written: about as
        many as keep a bucket's rows within one task."""
        self.spark = spark
        self.layout = layout
        self.opts = options
        self.files_per_batch = files_per_batch
        self.buckets = buckets
        self.ckpt = f"{(checkpoint_root or ensure_checkpoint_dir(spark)).rstrip('/')}/lakehouse"

    # ---- plumbing -------------------------------------------------------
    def exists(self, path: str) -> bool:
        """A table with data at ``path`` (feeds may land after the first run).
        Only a path that is not there, or holds no file yet, counts as absent."""
        if path.startswith(self.layout.gold("")):
            return all(self.versioned(p).exists for p in self._gold_paths(path))
        try:
            self.spark.read.parquet(path).schema
            return True
        except AnalysisException as e:
            if absent(e):
                return False
            raise

    def versioned(self, path: str) -> VersionedTable:
        return VersionedTable(self.spark, path, self.buckets)

    def _stream(self, path: str) -> DataFrame:
        schema = self.spark.read.parquet(path).schema  # file streams need a schema up front
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files_per_batch).parquet(path)

    def _drain(self, df: DataFrame, path: str, name: str, partition_by: list[str] | None = None) -> StreamingQuery:
        w = (
            df.writeStream.format("parquet")
            .option("path", path)
            .option("compression", COMPRESSION)
            .option("checkpointLocation", f"{self.ckpt}/{name}")
            .trigger(availableNow=True)
            .queryName(name)
        )
        if partition_by:
            w = w.partitionBy(*partition_by)
        return w.start()

    def clean_stream(self, entity: str) -> DataFrame:
        return self._stream(self.layout.silver(entity)).filter(F.col(STATUS) == "clean").drop(STATUS)

    def table(self, path: str) -> DataFrame:
        """The rows of a Bronze or Silver folder, or those in force of a Gold table."""
        if not path.startswith(self.layout.gold("")):
            return self.spark.read.parquet(path)
        name = path.removeprefix(self.layout.gold(""))
        tables = [self.versioned(p).read() for p in self._gold_paths(path)]
        if name in KPI_VIEWS:
            return KPI_VIEWS[name][1](*tables)
        if tables[0] is None:
            raise ValueError(f"no rows were ever written to {path}")
        return tables[0].drop(gold.EVENT_TIME)

    def _gold_paths(self, path: str) -> list[str]:
        name = path.removeprefix(self.layout.gold(""))
        return [self.layout.gold(f"partials/{part}") for part in KPI_VIEWS[name][0]] if name in KPI_VIEWS else [path]

    def gold_table(self, name: str) -> DataFrame:
        return self.table(self.layout.gold(name))

    def silver_table(self, entity: str, status: str = "clean") -> DataFrame:
        return self.table(self.layout.silver(entity)).filter(F.col(STATUS) == status).drop(STATUS)

    # ---- layers ---------------------------------------------------------
    def run_bronze(self, landing: str, specs: tuple[IngestSpec, ...] = DEFAULT_SPECS, max_files: int = 1000) -> None:
        finish([start_ingest(self.spark, landing, self.layout.bronze, spec, self.ckpt, max_files) for spec in specs])

    def _bronze_stream(self, entity: str) -> DataFrame:
        schema = read_bronze(self.spark, self.layout.bronze, entity).schema
        path = f"{self.layout.bronze}/{entity}"
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files_per_batch).parquet(path).drop("batch_id")

    def _has_bronze(self, entity: str) -> bool:
        return self.exists(f"{self.layout.bronze}/{entity}")

    def run_silver(self) -> None:
        """Entities whose feed has not landed yet are skipped until it has."""
        started = []
        for entity in ("customers", "transactions", "returns", "products", "vendors"):
            if self._has_bronze(entity):
                base = silver.BASES[entity](self._bronze_stream(entity), self.opts)
                started.append(self._drain(with_status(base), self.layout.silver(entity), f"silver_{entity}", [STATUS]))
        finish(started)
        if self._has_bronze("orders") and self.exists(self.layout.silver("customers")):
            customers = self.silver_table("customers")  # static snapshot for the stream–static join
            orders = silver.orders_base(self._bronze_stream("orders"), customers, self.opts)
            finish([self._drain(with_status(orders), self.layout.silver("orders"), "silver_orders", [STATUS])])

    def _apply(self, df: DataFrame, name: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
        """Drains a stream into ``batch(rows, number)``."""
        return df.writeStream.foreachBatch(batch).option("checkpointLocation", f"{self.ckpt}/{name}").trigger(availableNow=True).queryName(name).start()

    def _pair(self, left: str, left_columns: list[str], right: str, right_columns: list[str]) -> DataFrame:
        """Two clean Silver streams as one, so that a micro-batch holds the new rows of both."""
        sides = ((left, left_columns, "left"), (right, right_columns, "right"))
        streams = {side: self.clean_stream(entity).select(*columns) for entity, columns, side in sides}
        none = {side: F.lit(None).cast(df.schema) for side, df in streams.items()}
        tagged = [df.select(*[(F.struct(*df.columns) if s == side else none[s]).alias(s) for s in streams]) for side, df in streams.items()]
        return tagged[0].unionByName(tagged[1])

    @staticmethod
    def _sides(batch: DataFrame) -> list[DataFrame]:
        return [batch.where(F.col(s).isNotNull()).select(f"{s}.*") for s in ("left", "right")]

    def run_gold(self) -> None:
        """Each Gold table is maintained once all the Silver tables it reads exist; they
        do not depend on each other and run side by side."""
        started = []
        dims = {
            "dim_customer": ("customers", gold.CUSTOMER_COLUMNS, ["customer_id"]),
            "dim_product": ("products", gold.PRODUCT_COLUMNS, ["product_id"]),
            "dim_vendor": ("vendors", gold.VENDOR_COLUMNS, ["vendor_id"]),
        }
        there = {e: self.exists(self.layout.silver(e)) for e in silver.ENTITIES}
        for name, (entity, columns, keys) in dims.items():
            if there[entity]:
                rows = KeyedTable(self.versioned(self.layout.gold(name)), keys, [gold.EVENT_TIME])
                started.append(self._apply(self.clean_stream(entity).select(*columns, gold.EVENT_TIME), name, rows.upsert))
        if there["orders"] and there["returns"]:
            dates = KeyedTable(self.versioned(self.layout.gold("dim_date")), ["date"])
            stream = self._pair("orders", ["order_purchase_date"], "returns", ["return_date"])
            started.append(self._apply(stream, "dim_date", lambda batch, n: dates.upsert(gold.dim_date(*self._sides(batch)), n)))
        facts = [
            ("fact_transactions", ("orders", gold.ORDER_COLUMNS), ("transactions", gold.TRANSACTION_COLUMNS), gold.fact_transactions, self._transaction_kpis),
            ("fact_returns", ("returns", gold.RETURN_COLUMNS), ("orders", gold.ORDER_COLUMNS), gold.fact_returns, self._return_kpis),
        ]
        for name, left, right, join, kpis in facts:
            if there[left[0]] and there[right[0]]:
                facts_of = DeltaJoin(self.versioned(self.layout.gold(name)), "order_id", join)
                started.append(self._apply(self._pair(*left, *right), name, self._fact_batch(facts_of, kpis())))
        finish(started)

    def _fact_batch(self, facts: DeltaJoin, kpis: list[MergedAggregate]) -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, n: int) -> None:
            added = facts.apply(*self._sides(batch), n)  # the same rows again if the batch is run again
            with ThreadPoolExecutor(len(kpis)) as pool:  # each has a table of its own
                for done in [pool.submit(kpi.apply, added, n) for kpi in kpis]:
                    done.result()

        return run

    def _kpi(self, name: str, keys: list[str], **how) -> MergedAggregate:
        return MergedAggregate(self.versioned(self.layout.gold(f"partials/{name}")), keys, **how)

    def _transaction_kpis(self) -> list[MergedAggregate]:
        month = {"month": F.date_format("date", gold.MONTH_FORMAT)}
        return [
            self._kpi("monthly_revenue", ["region", "month"], sums={"total_sales": money("sales_amount")}, distinct="order_id", derived=month),
            self._kpi("vendor_orders", ["vendor_id"], distinct="order_id"),
            self._kpi("product_units", ["product_id", "region"], sums={"total_quantity_sold": F.col("quantity")}),
        ]

    def _return_kpis(self) -> list[MergedAggregate]:
        return [self._kpi("customer_returns", ["customer_id"], sums={"total_refund_amount": money("refund_amount")}), self._kpi("vendor_returns", ["vendor_id"])]

    def run(self, landing: str, max_files: int = 1000, specs: tuple[IngestSpec, ...] = DEFAULT_SPECS) -> None:
        self.run_bronze(landing, specs, max_files=max_files)
        self.run_silver()
        self.run_gold()


def main(argv: list[str] | None = None) -> None:
    """``python -m ledgerline.streaming.runner LANDING LAKE_ROOT``
    (or via spark-submit): drain new landing files through every layer. The
    session comes from the launcher's configuration; its
    ``spark.checkpoint.dir`` holds the stream checkpoints."""
    import argparse

    from ..session import apply_runtime_conf

    ap = argparse.ArgumentParser(description=main.__doc__)
    ap.add_argument("landing")
    ap.add_argument("lake_root")
    ap.add_argument("--max-files", type=int, default=1000)
    ap.add_argument("--buckets", type=int, default=BUCKETS, help="key buckets of Gold tables that are written for the first time")
    ap.add_argument("--keep-raw", action="store_true", help="keep raw columns beside the canonical ones in Silver")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    apply_runtime_conf(spark)
    options = silver.SilverOptions(keep_raw=args.keep_raw)
    Runner(spark, Layout(args.lake_root), options, buckets=args.buckets).run(args.landing, max_files=args.max_files)


if __name__ == "__main__":
    main()
