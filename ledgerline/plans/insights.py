"""KPI views and the AI-insights table (UC4: I1–I4, A8, A9, A13, M3, M4).

The reference packs a whole KPI view into one JSON array with a global
``collect_list``: one task, one row, growing with the number of vendors. Here a view
is summed up as a tree. Its rows are dealt by a hash of their key into pages of about
``PAGE_SIZE`` entries; a page becomes a JSON array and a summary. ``FANOUT`` nodes at a
time become one node of the next level, with the figures of all the entries below (counts
and sums, and the highest and lowest entries, all of which merge) and a summary of its
children's summaries, up to a single root. So there is one insight a view at every size,
and no group ever holds more than a page or ``FANOUT`` children.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import MONEY_TEXT, money, money_sum
from ..operators.generate import TextModel, generate_text
from ..sources.tables import stage

PAGE_SIZE = 20
FANOUT = 10
EXTREMES = 3  # highest and lowest entries kept in a node
RATE_TYPE = "decimal(20,6)"

# Insight types and the instruction put before each KPI JSON.
INSTRUCTIONS = {
    "revenue_performance": (
        "You are a senior retail executive. Provide a 4-6 sentence executive summary highlighting key "
        "revenue trends, top-performing regions, and risks: "
    ),
    "vendor_return_rate": (
        "Analyze vendor return rates. Identify high-return vendors, possible quality issues, and business "
        "risks. Provide a 4-6 sentence executive summary: "
    ),
    "slow_moving_inventory": (
        "Analyze slow-moving inventory across regions. Highlight overstock risks and underperforming "
        "regions. Provide a 4-6 sentence executive summary: "
    ),
}
SUMMARY_TEMPLATE = "%s: %d entries, %s; highest %s, lowest %s by %s."


def kpi_revenue(agg_monthly_revenue: DataFrame) -> DataFrame:
    """Revenue and orders by region."""
    return agg_monthly_revenue.groupBy("region").agg(
        money_sum("total_sales").alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
    )


def kpi_vendor(agg_vendor_performance: DataFrame) -> DataFrame:
    """Return rate and volumes by vendor."""
    return agg_vendor_performance.groupBy("vendor_id").agg(
        F.avg("return_rate").alias("avg_return_rate"),
        F.sum("total_returns").alias("total_returns"),
        F.sum("total_orders").alias("total_orders"),
    )


def kpi_slow_moving(agg_slow_moving_products: DataFrame) -> DataFrame:
    """Slow-moving product count and units by region."""
    return agg_slow_moving_products.groupBy("region").agg(
        F.count("product_id").alias("slow_product_count"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
    )


@dataclass(frozen=True)
class KpiSpec:
    insight_type: str
    key: str
    fields: Sequence[Column]  # of a JSON entry
    lead: str  # the measure that ranks entries
    totals: dict[str, tuple[Column, str]]  # name → (value that adds up, type of the sum)


def kpi_specs() -> list[KpiSpec]:
    """JSON entry per view row; money and rates at fixed scale so the text is
    exact and engine-independent."""
    c = F.col
    return [
        KpiSpec(
            "revenue_performance",
            "region",
            [c("region"), c("total_revenue").cast(MONEY_TEXT).alias("total_revenue"), c("total_orders")],
            "total_revenue",
            {"total_revenue": (money("total_revenue"), MONEY_TEXT), "total_orders": (c("total_orders"), "bigint")},
        ),
        KpiSpec(
            "vendor_return_rate",
            "vendor_id",
            [c("vendor_id"), c("avg_return_rate").cast(RATE_TYPE).alias("avg_return_rate"), c("total_returns"), c("total_orders")],
            "avg_return_rate",
            {"total_returns": (c("total_returns"), "bigint"), "total_orders": (c("total_orders"), "bigint")},
        ),
        KpiSpec(
            "slow_moving_inventory",
            "region",
            [c("region"), c("slow_product_count"), c("total_quantity_sold")],
            "slow_product_count",
            {"slow_product_count": (c("slow_product_count"), "bigint"), "total_quantity_sold": (c("total_quantity_sold"), "bigint")},
        ),
    ]


def page_of(key: Column, n_pages: int) -> Column:
    """Stable page for a key: first 32 bits of its MD5, modulo the page count
    (a NULL key goes to page 0)."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(h, F.lit(n_pages)), F.lit(0)).cast("int")


def _extremes(entries: Column, spec: KpiSpec, highest: bool) -> Column:
    """The ``EXTREMES`` entries with the greatest or smallest lead measure, ties by key; NULL measures last."""

    def order(e: Column) -> Column:
        lead = -e[spec.lead] if highest else e[spec.lead]
        return F.struct(lead.isNull().alias("none"), lead.alias("lead"), e[spec.key].alias("key"), e.alias("entry"))

    ordered = F.array_sort(F.transform(entries, order))
    return F.slice(F.transform(ordered, lambda x: x["entry"]), 1, EXTREMES)


def _summary_text(spec: KpiSpec) -> Column:
    """The default summary of any node, from its figures alone."""
    totals = F.concat_ws(", ", *[F.concat(F.lit(f"{name} "), F.coalesce(F.col(name).cast("string"), F.lit("unknown"))) for name in spec.totals])
    first = lambda c: F.coalesce(F.try_element_at(c, F.lit(1))[spec.key].cast("string"), F.lit("none"))
    return F.format_string(SUMMARY_TEMPLATE, F.lit(spec.insight_type), F.col("n_entries"), totals, first(F.col("highest")), first(F.col("lowest")), F.lit(spec.lead))


def _figures(spec: KpiSpec) -> Column:
    return F.to_json(F.struct("n_entries", *spec.totals, "highest", "lowest"))


def _nodes(df: DataFrame, spec: KpiSpec, level: int, model: TextModel | None) -> DataFrame:
    """Prompts and summaries of one level, written once (a model is asked once)."""
    df = df.withColumn("level", F.lit(level)).withColumn("prompt", F.concat(F.lit(INSTRUCTIONS[spec.insight_type]), F.col("asked")))
    return stage(generate_text(df.drop("asked"), "prompt", "summary", model, _summary_text(spec)), f"insight-{spec.insight_type}-{level}")


def kpi_pages(view: DataFrame, spec: KpiSpec, n_pages: int) -> DataFrame:
    """Level 0: ``kpi_data`` = JSON array of the page's entries by key (A8, M3), and their figures."""
    values = [value.alias(f"_{name}") for name, (value, _) in spec.totals.items()]
    entries = view.select(page_of(F.col(spec.key), n_pages).alias("node"), F.struct(*spec.fields).alias("entry"), *values)
    sums = [F.sum(f"_{name}").cast(kind).alias(name) for name, (_, kind) in spec.totals.items()]
    pages = entries.groupBy("node").agg(F.array_sort(F.collect_list("entry")).alias("entries"), *sums)
    return pages.select(
        "node",
        F.size("entries").cast("long").alias("n_entries"),
        *spec.totals,
        _extremes(F.col("entries"), spec, True).alias("highest"),
        _extremes(F.col("entries"), spec, False).alias("lowest"),
        F.to_json("entries").alias("kpi_data"),
        F.to_json("entries").alias("asked"),
    )


def kpi_parents(children: DataFrame, spec: KpiSpec, fanout: int) -> DataFrame:
    """The next level: figures of ``fanout`` nodes merged, their summaries as the prompt."""
    said = F.struct(F.col("node"), F.col("n_entries"), F.col("summary"))
    sums = [F.sum(name).cast(kind).alias(name) for name, (_, kind) in spec.totals.items()]
    merged = children.groupBy(F.floor(F.col("node") / fanout).cast("int").alias("node")).agg(
        F.sum("n_entries").alias("n_entries"),
        *sums,
        F.flatten(F.collect_list("highest")).alias("highest"),
        F.flatten(F.collect_list("lowest")).alias("lowest"),
        F.array_sort(F.collect_list(said)).alias("children"),
    )
    merged = merged.withColumns({"highest": _extremes(F.col("highest"), spec, True), "lowest": _extremes(F.col("lowest"), spec, False)})
    return merged.withColumn("kpi_data", _figures(spec)).withColumn("asked", F.to_json("children")).drop("children")


def summary_tree(views: dict[str, DataFrame], model: TextModel | None = None, page_size: int = PAGE_SIZE, fanout: int = FANOUT) -> DataFrame:
    """Every node of the three trees: insight_type, level (0: pages), node, n_pages of the view, n_entries,
    ``root``, prompt, summary and kpi_data. A view without rows has no node. The views
    are read twice (their count, their pages): hand in written ones."""

    def grown(spec: KpiSpec) -> list[DataFrame]:
        out = []
        view = views[spec.insight_type]
        n = n_pages = max(1, -(-view.count() // page_size))
        level, nodes = 0, _nodes(kpi_pages(view, spec, n), spec, 0, model)
        while True:
            root = level > 0 and n == 1  # a page is never the root, however few the rows
            out.append(nodes.select(F.lit(spec.insight_type).alias("insight_type"), "level", "node", F.lit(n_pages).alias("n_pages"), "n_entries", F.lit(root).alias("root"), "prompt", "summary", "kpi_data"))
            if root:
                break
            n, level = -(-n // fanout), level + 1
            nodes = _nodes(kpi_parents(nodes, spec, fanout), spec, level, model)
        return out

    specs = kpi_specs()
    with ThreadPoolExecutor(len(specs)) as pool:  # the trees do not depend on each other
        trees = list(pool.map(grown, specs))
    return reduce(DataFrame.unionByName, [level for tree in trees for level in tree])


def insights(tree: DataFrame, stamp: bool = True) -> DataFrame:
    """The insights table (I4): one row per insight, the root of its tree. ``kpi_data`` holds the
    figures of the whole view; the entries themselves are in the level 0 rows of the tree."""
    out = tree.where("root").select("insight_type", "n_entries", "summary", "kpi_data")
    return out.withColumn("generated_at", F.current_timestamp()) if stamp else out


def insights_whole(tree: DataFrame) -> DataFrame:
    """The insights with all that they rest on: the insight of each view (``page`` NULL), and its pages,
    whose ``kpi_data`` together hold every entry of the view."""
    page = F.when(~F.col("root"), F.col("node")).alias("page")
    return tree.where("root OR level = 0").select("insight_type", page, "n_pages", "n_entries", "summary", "kpi_data")
