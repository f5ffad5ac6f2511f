"""Data-quality failure report with a business-impact explanation (UC1: Q18,
M1, M4, M5, X1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.generate import TextModel, generate_text, parse_reply
from ..operators.quality import failure_counts
from .silver import rule_reasons

# Reply key and the text used when a reply lacks it.
IMPACT_KEY = "business_impact"
IMPACT_MISSING = "Impact could not be generated"

PROMPT_TEMPLATE = (
    "table=%s check=%s finding=%s records=%d\n"
    "These records are held back from reporting. Say in at most four sentences what that costs the business. "
    'Answer with one JSON object: "entity_name", "issue_type" and your text as "business_impact".'
)
IMPACT_TEMPLATE = (
    "%d %s records fail the %s check (%s). They are held in quarantine and excluded from "
    "Gold revenue, returns and vendor reporting until the source is corrected."
)


def failure_report(quarantine_tables: Mapping[str, DataFrame], per_rule_reason: bool = False) -> DataFrame:
    """Failed-check counts for every entity given (all six by default); with
    ``per_rule_reason`` each failed check carries its own reason."""
    parts = [failure_counts(df, entity, per_rule_reason, rule_reasons(entity) if per_rule_reason else None) for entity, df in quarantine_tables.items()]
    return reduce(DataFrame.unionByName, parts)


def dq_prompts(counts: DataFrame) -> DataFrame:
    """One prompt per (entity, field, issue) row (M1)."""
    prompt = F.format_string(PROMPT_TEMPLATE, "entity_name", "field_name", "issue_type", "failed_count")
    return counts.withColumn("prompt", prompt)


def template_reply() -> Column:
    """Deterministic stand-in for the model: the JSON object the prompt asks for."""
    impact = F.format_string(IMPACT_TEMPLATE, "failed_count", "entity_name", "field_name", "issue_type")
    return F.to_json(
        F.struct(F.col("entity_name"), F.col("issue_type"), impact.alias(IMPACT_KEY))
    )


def explain(counts: DataFrame, model: TextModel | None = None) -> DataFrame:
    """Prompt → reply → parsed ``business_impact`` per row, keyed by (entity,
    field, issue) so two fields sharing an issue never cross-multiply."""
    replies = generate_text(dq_prompts(counts), "prompt", "reply", model, template_reply())
    return replies.withColumn(IMPACT_KEY, parse_reply(F.col("reply"), IMPACT_KEY, IMPACT_MISSING))


def attach_explanations(counts: DataFrame, explanations: DataFrame, keys: Sequence[str] = ("entity_name", "issue_type", "field_name")) -> DataFrame:
    """Counts ⟕ stored explanations on (entity, issue, field)."""
    expl = explanations.select(*keys, IMPACT_KEY)
    return counts.join(expl, list(keys), "left")


def audit_report(quarantine_tables: Mapping[str, DataFrame], model: TextModel | None = None, stamp: bool = True) -> DataFrame:
    """``dq_audit_report`` (X1): every count row with its explanation. The
    explanation is generated on the row itself (no driver round trip), so no
    join back is needed; ``attach_explanations`` covers stored replies."""
    counts = failure_report(quarantine_tables)
    out = explain(counts, model).select("entity_name", "issue_type", "field_name", "failed_count", IMPACT_KEY)
    return out.withColumn("generated_at", F.current_timestamp()) if stamp else out
