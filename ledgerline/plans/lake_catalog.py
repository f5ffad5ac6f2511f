"""The runner's tables in the catalog (K3, K11, K12): one name each for Bronze, clean and
quarantined Silver, Gold, and the KPI tables, with comments, for SQL users.

Bronze folders are external tables, partitioned by ingest batch; the partitions are
repaired on every call. Silver and Gold are views: a view over a streamed folder reads by the sink's
commit log, and a view over a versioned table names the folders in force, so neither shows
rows of a write that failed. Call this after every run, or from the job that runs it.
"""

from __future__ import annotations

from ..operators.quality import STATUS
from ..sources.versions import ROWS, VersionedTable
from ..streaming.runner import KPI_VIEWS, Runner
from ..streaming.schema_log import SchemaLog
from . import gold
from .silver import ENTITIES

# Comments by layer, and the KPI tables in SQL over their stored partials.
COMMENTS = {
    "bronze": "Raw %s as landed, all values text, with source file and ingest time",
    "silver": "Clean %s",
    "quarantine": "Rejected %s with the failed checks and the reason",
    "gold": "Gold table %s, kept up to date by deltas",
}
KPI_SQL = {
    "agg_monthly_revenue": "SELECT region, month, CAST(total_sales AS DOUBLE) AS total_sales, n_distinct AS order_count FROM {0}",
    "agg_customer_returns": "SELECT customer_id, n_rows AS return_count, CAST(total_refund_amount AS DOUBLE) AS total_refund_amount FROM {0}",
    "agg_vendor_performance": (
        "SELECT o.vendor_id, o.n_distinct AS total_orders, coalesce(r.n_rows, 0) AS total_returns, "
        "try_divide(CAST(coalesce(r.n_rows, 0) AS DOUBLE), o.n_distinct) AS return_rate FROM {0} o LEFT JOIN {1} r ON o.vendor_id = r.vendor_id"
    ),
    "agg_slow_moving_products": f"SELECT product_id, region, total_quantity_sold FROM {{0}} WHERE total_quantity_sold < {gold.SLOW_MOVING_THRESHOLD}",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_force(table: VersionedTable) -> str:
    """SELECT of the rows in force: a filter on the folders that the manifest names."""
    rows = table.read()
    if rows is None:
        raise ValueError(f"no rows were ever written to {table.root}")
    by_folder: dict[str, list[int]] = {}
    for e in table.entries:
        if e.part == ROWS and e.n_rows:
            by_folder.setdefault(e.folder.removeprefix("v="), []).append(e.bucket)
    chosen = " OR ".join(f"(v = {_quoted(v)} AND bucket IN ({', '.join(map(str, sorted(b)))}))" for v, b in by_folder.items())
    names = ", ".join(f"`{c}`" for c in rows.columns if c != gold.EVENT_TIME)
    return f"SELECT {names} FROM parquet.`{table.root}` WHERE {chosen}"


def register_tables(runner: Runner, database: str) -> list[str]:
    """Creates or refreshes all tables that have rows; returns their names."""
    spark, layout, names = runner.spark, runner.layout, []
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def view(name: str, comment: str, select: str, listed: bool = True) -> None:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} COMMENT {_quoted(comment)} AS {select}")
        if listed:
            names.append(name)

    for entity in ENTITIES:
        if runner.exists(f"{layout.bronze}/{entity}"):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SchemaLog(spark, layout.bronze, entity).text_schema())
            name = f"{database}.bronze_{entity}"
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
            spark.sql(f"CREATE TABLE {name} ({columns}, batch_id INT) USING parquet PARTITIONED BY (batch_id) LOCATION {_quoted(f'{layout.bronze}/{entity}')} COMMENT {_quoted(COMMENTS['bronze'] % entity)}")
            spark.sql(f"MSCK REPAIR TABLE {name}")
            names.append(f"bronze_{entity}")
    for layer, status in (("silver", "clean"), ("quarantine", "quarantine")):
        for entity in ENTITIES:
            if runner.exists(layout.silver(entity)):
                columns = ", ".join(f"`{c}`" for c in runner.table(layout.silver(entity)).columns if c != STATUS)
                view(f"{layer}_{entity}", COMMENTS[layer] % entity, f"SELECT {columns} FROM parquet.`{layout.silver(entity)}` WHERE {STATUS} = '{status}'")
    for name in ("dim_customer", "dim_product", "dim_vendor", "dim_date", "fact_transactions", "fact_returns"):
        if runner.exists(layout.gold(name)):
            view(name, COMMENTS["gold"] % name, in_force(runner.versioned(layout.gold(name))))
    for name, (parts, _) in KPI_VIEWS.items():
        if runner.exists(layout.gold(name)) and all(runner.versioned(layout.gold(f"partials/{p}")).read() is not None for p in parts):
            for part in parts:
                view(f"partial_{part}", COMMENTS["gold"] % part, in_force(runner.versioned(layout.gold(f"partials/{part}"))), listed=False)
            view(name, COMMENTS["gold"] % name, KPI_SQL[name].format(*[f"{database}.partial_{p}" for p in parts]))
    return names
