"""Table access: parquet tables by name, and the catalog sinks the jobs use."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Reads ``{root}/{name}.parquet``; an explicit column list keeps the scan's
    ReadSchema narrow even before Catalyst prunes the rest."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str, columns: Iterable[str] | None = None) -> DataFrame:
        # one reader per table: file listing and footer schema are resolved once
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        df = self._frames[name]
        cols = list(columns or [])
        return df.select(*cols) if cols else df


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet under the cluster's shared checkpoint
    folder and return a reader of it. Used when one query consumes the same
    intermediate several times with different column sets (so Spark cannot
    reuse the exchanges): the lineage runs once, the copy survives executor
    loss, and each consumer still prunes columns on read."""
    from ..session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/ledgerline-stage/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def overwrite_table(df: DataFrame, name: str, partition_by: list[str] | None = None, comment: str | None = None) -> None:
    """Materialized table: full recompute, dropped and written again (K5/K6). Not atomic: use
    ``versions`` where readers must keep the old rows until the new ones are there."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    if comment:
        set_comment(df.sparkSession, name, comment)


def append_table(df: DataFrame, name: str) -> None:
    """Append to a managed table, creating it on first use (K7)."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def create_table_if_absent(spark: SparkSession, name: str, ddl: str) -> None:
    """``CREATE TABLE IF NOT EXISTS name (ddl) USING parquet`` (K8)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")


def set_comment(spark: SparkSession, name: str, comment: str) -> None:
    """Table comment metadata."""
    text = comment.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('comment' = '{text}')")


def set_view_comment(spark: SparkSession, name: str, comment: str) -> None:
    text = comment.replace("'", "\\'")
    spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ('comment' = '{text}')")
