"""Publishing the consumer outputs as catalog tables.

A published table is a catalog view over the newest folder of a versioned table: new
rows are written and counted beside the old ones, then the view is pointed at them in one
catalog call. A write that fails leaves the old rows readable. The query log is a
table that is appended to.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.generate import TextModel, generate_text
from ..sources.tables import append_table, set_view_comment
from ..sources.versions import publish
from .retrieval import query_log

# Published table schemas.
INSIGHTS_DDL = "insight_type STRING, n_entries LONG, summary STRING, kpi_data STRING, generated_at TIMESTAMP"


def use_namespace(spark: SparkSession, database: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` + make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.catalog.setCurrentDatabase(database)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Session temp views, e.g. the KPI views for ad-hoc SQL."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def location(spark: SparkSession, table: str) -> str:
    """Where a published table's versions lie: in the warehouse, by database and name."""
    name = table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/published/{name.replace('.', '/')}"


def publish_overwrite(df: DataFrame, table: str, comment: str | None = None) -> int:
    """Replace a table and return its row count, observed during the write
    and checked against what can be read (K6, K12, K13)."""
    spark = df.sparkSession
    n = publish(spark, df, table, location(spark, table))
    if comment:
        set_view_comment(spark, table, comment)
    return n


def publish_insights(spark: SparkSession, insights_df: DataFrame, table: str) -> None:
    """The insights table: created empty if absent, then its rows replaced."""
    if not spark.catalog.tableExists(table):
        publish_overwrite(spark.createDataFrame([], INSIGHTS_DDL), table)
    cols = [c.split()[0] for c in INSIGHTS_DDL.split(", ")]
    publish_overwrite(insights_df.select(*cols), table)


def empty_table(spark: SparkSession, table: str) -> None:
    """Remove all rows (K9); readers of the version before keep theirs."""
    publish_overwrite(spark.table(table).where(F.lit(False)), table)


def log_answers(answers: DataFrame, table: str) -> None:
    """Append one row per answered question to the query history."""
    append_table(query_log(answers), table)


def ask_once(spark: SparkSession, prompt: str, model: TextModel | None = None, default: Column | None = None) -> DataFrame:
    """A single model call without a source table, like a bare ``SELECT model_call(…)``
    (S12): a one-row frame carrying the prompt and its reply."""
    one = spark.range(1).select(F.lit(prompt).alias("prompt"))
    return generate_text(one, "prompt", "reply", model, default if default is not None else F.lit(None).cast("string"))
