"""Return-abuse scoring and investigation briefs (UC2: F1–F7, M2, M4, M6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import MONEY_TEXT, money_sum
from ..operators.generate import TextModel, generate_text, with_fallback
from ..operators.scoring import ScoreRule, score_rules

# The five abuse rules (column, threshold, points, label), the
# flag threshold, the recent-returns window and the brief fallback text.
FLAG_THRESHOLD = 40
RECENT_WINDOW_DAYS = 30
BRIEF_FALLBACK = "Investigation brief unavailable."


def abuse_rules() -> list[ScoreRule]:
    c = F.col
    return [
        ScoreRule("rule_high_volume", c("total_returns") >= 5, 25, "High return volume"),
        ScoreRule("rule_high_value", c("total_return_value") >= 25000, 20, "High refund value"),
        ScoreRule("rule_high_ratio", c("return_to_order_ratio") >= 0.5, 25, "High return-to-order ratio"),
        ScoreRule("rule_recent_spike", c("last_30_day_returns") >= 3, 20, "Recent return spike"),
        ScoreRule("rule_refund_dominance", c("total_return_value") > c("total_sales_value"), 10, "Refunds exceed purchases"),
    ]


PROMPT_TEMPLATE = (
    "customer_id=%s returns=%d refunded=%s returns_per_order=%s score=%d\n"
    "triggered: %s\n"
    "For the case file, state in at most four sentences which of these figures stand out, how an honest "
    "customer could come by them, and which record to open first. Draw no conclusion about guilt."
)
BRIEF_TEMPLATE = (
    "Customer %s has %d returns and an anomaly score of %d (%s). Innocent causes such as defective "
    "items or sizing problems are possible. Review the order history and refund approvals first."
)


def as_of_date(fact_returns: DataFrame, as_of: dt.date | str | None) -> Column:
    """The reporting date: given, or the latest return date in the data (a
    one-value scalar subquery, deterministic unlike ``current_date``)."""
    if as_of is not None:
        return F.lit(as_of).cast("date")
    return fact_returns.select(F.max("date")).scalar()


def return_profile(fact_returns: DataFrame, as_of: dt.date | str | None = None, window_days: int = RECENT_WINDOW_DAYS) -> DataFrame:
    """Per customer: returns, refund value, latest return, returns on or after
    ``as_of - window_days`` (F1)."""
    since = F.date_sub(as_of_date(fact_returns, as_of), window_days)
    return fact_returns.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_returns"),
        money_sum("refund_amount").alias("total_return_value"),
        F.max("date").alias("latest_return_date"),
        F.count_if(F.col("date") >= since).alias("last_30_day_returns"),
    )


def sales_profile(fact_transactions: DataFrame) -> DataFrame:
    """Per customer: distinct orders and sales value (F2)."""
    return fact_transactions.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_sum("sales_amount").alias("total_sales_value"),
    )


def customer_return_profile(returns_p: DataFrame, sales_p: DataFrame) -> DataFrame:
    """Returns ⟕ sales, missing sales as 0, ratio with divisor at least 1."""
    orders = F.col("total_orders")
    return (
        returns_p.join(sales_p, "customer_id", "left")
        .fillna(0, subset=["total_orders", "total_sales_value"])
        .withColumn("return_to_order_ratio", F.col("total_returns") / F.when(orders == 0, F.lit(1)).otherwise(orders))
    )


def anomaly_score(profile: DataFrame) -> DataFrame:
    """Five rules → ``anomaly_score`` 0–100 and ``violated_rules``."""
    return score_rules(profile, abuse_rules(), "anomaly_score", "violated_rules")


def flagged(scored: DataFrame, threshold: int = FLAG_THRESHOLD) -> DataFrame:
    """Customers at or above the threshold."""
    return scored.filter(F.col("anomaly_score") >= threshold)


def fraud_prompts(flagged_df: DataFrame) -> DataFrame:
    """Prompt per flagged customer (M2). Money is printed at fixed scale and the
    ratio rounded to 2 places, so the text is the same on every engine."""
    prompt = F.format_string(
        PROMPT_TEMPLATE,
        F.col("customer_id"),
        F.col("total_returns"),
        F.col("total_return_value").cast(MONEY_TEXT).cast("string"),
        F.round(F.col("return_to_order_ratio"), 2).cast("decimal(10,2)").cast("string"),
        F.col("anomaly_score"),
        F.col("violated_rules"),
    )
    return flagged_df.withColumn("prompt", prompt)


def template_brief() -> Column:
    return F.format_string(BRIEF_TEMPLATE, "customer_id", "total_returns", "anomaly_score", "violated_rules")


def flagged_return_customers(flagged_df: DataFrame, model: TextModel | None = None, stamp: bool = True) -> DataFrame:
    """Flagged customers with an investigation brief, fixed schema."""
    briefs = generate_text(fraud_prompts(flagged_df), "prompt", "investigation_brief", model, template_brief())
    out = briefs.select(
        F.col("customer_id").cast("string"),
        F.col("total_returns").cast("bigint"),
        F.col("total_return_value").cast("double"),
        F.col("anomaly_score").cast("int"),
        F.col("violated_rules").cast("string"),
        with_fallback(F.col("investigation_brief"), BRIEF_FALLBACK).alias("investigation_brief"),
    )
    return out.withColumn("generated_at", F.current_timestamp()) if stamp else out
