"""Wires raw entity frames through Silver and Gold.

Every attribute is a lazily built DataFrame; nothing runs until an action.
The same wiring serves the testbed (driver tables), Bronze tables written by
the ingest streams, and unit-test fixtures.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import clean, quarantine
from ..sources.tables import Tables, stage
from ..sources.testbed import raw_entities
from . import gold, silver


class Lakehouse:
    """``stage`` names the facts (or clean entities) to write once (parquet
    under the shared checkpoint folder) because the consumer reads them
    several times with different column sets; given as a mapping, only the named columns
    of each are written. Everything else stays one lazy plan."""

    def __init__(self, raw: Mapping[str, DataFrame], options: silver.SilverOptions = silver.SilverOptions(), stage: Iterable[str] | Mapping[str, list[str]] = ()):
        self.raw = raw
        self.opts = options
        self.staged = dict(stage) if isinstance(stage, Mapping) else dict.fromkeys(stage)
        self._staged_clean: dict[str, DataFrame] = {}

    @classmethod
    def from_testbed(
        cls, spark: SparkSession, sf_dir: str, options: silver.SilverOptions = silver.SilverOptions(), stage: Iterable[str] | Mapping[str, list[str]] = ()
    ) -> "Lakehouse":
        return cls(raw_entities(Tables(spark, sf_dir)), options, stage)

    # ---- Silver base views --------------------------------------------
    def base(self, entity: str) -> DataFrame:
        return getattr(self, f"{entity}_base")

    @cached_property
    def customers_base(self) -> DataFrame:
        return silver.customers_base(self.raw["customers"], self.opts)

    @cached_property
    def orders_base(self) -> DataFrame:
        return silver.orders_base(self.raw["orders"], self.clean("customers"), self.opts)

    @cached_property
    def transactions_base(self) -> DataFrame:
        return silver.transactions_base(self.raw["transactions"], self.opts)

    @cached_property
    def returns_base(self) -> DataFrame:
        return silver.returns_base(self.raw["returns"], self.opts)

    @cached_property
    def products_base(self) -> DataFrame:
        return silver.products_base(self.raw["products"], self.opts)

    @cached_property
    def vendors_base(self) -> DataFrame:
        return silver.vendors_base(self.raw["vendors"], self.opts)

    def clean(self, entity: str) -> DataFrame:
        if entity in self.staged:
            if entity not in self._staged_clean:
                self._staged_clean[entity] = self._written(clean(self.base(entity)), entity)
            return self._staged_clean[entity]
        return clean(self.base(entity))

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        if name not in self.staged:
            return df
        columns = self.staged[name]
        return stage(df.select(*columns) if columns else df, name)

    def quarantine(self, entity: str) -> DataFrame:
        return quarantine(self.base(entity))

    # ---- Gold ----------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.clean("customers"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.clean("products"))

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return gold.dim_vendor(self.clean("vendors"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.clean("orders"), self.clean("returns"))

    @cached_property
    def fact_transactions(self) -> DataFrame:
        df = gold.fact_transactions(self.clean("orders"), self.clean("transactions"))
        return self._written(df, "fact_transactions")

    @cached_property
    def fact_returns(self) -> DataFrame:
        df = gold.fact_returns(self.clean("returns"), self.clean("orders"))
        return self._written(df, "fact_returns")

    @cached_property
    def agg_monthly_revenue(self) -> DataFrame:
        return gold.agg_monthly_revenue(self.fact_transactions)

    @cached_property
    def agg_customer_returns(self) -> DataFrame:
        return gold.agg_customer_returns(self.fact_returns)

    @cached_property
    def agg_vendor_performance(self) -> DataFrame:
        return gold.agg_vendor_performance(self.fact_transactions, self.fact_returns)

    @cached_property
    def agg_slow_moving_products(self) -> DataFrame:
        return gold.agg_slow_moving_products(self.fact_transactions)
