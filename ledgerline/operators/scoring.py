"""Additive rule scoring (F4, F5): each rule adds points when its condition
holds; the violated rules are listed in rule order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScoreRule:
    name: str
    condition: Column
    points: int
    label: str


def score_rules(df: DataFrame, rules: Sequence[ScoreRule], score_col: str = "score", text_col: str = "violated_rules", sep: str = ", ") -> DataFrame:
    """Add one points column per rule (0 when the condition is false or NULL),
    their sum, and the comma-joined labels of the rules that fired."""
    points = {r.name: F.when(r.condition, F.lit(r.points)).otherwise(F.lit(0)) for r in rules}
    total = F.lit(0)
    for r in rules:
        total = total + F.col(r.name)
    text = F.concat_ws(sep, *[F.when(F.col(r.name) > 0, F.lit(r.label)) for r in rules])
    return df.withColumns(points).withColumns({score_col: total.cast("int"), text_col: text})
