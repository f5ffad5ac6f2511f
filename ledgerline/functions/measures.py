"""Measures. Money is summed as DECIMAL: a double sum depends on the order
rows meet, which changes with partitioning and executor count, so the same
data could score a customer differently run to run. Fixed-point sums are
exact and order-free; results go back to double for the published schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ten decimals and 28 digits before them: amounts are kept as they are, and the
# silver rules quarantine what does not fit
MONEY_TYPE = "decimal(38,10)"
MONEY_TEXT = "decimal(38,4)"  # how money is printed in prompts and JSON
MONEY_LIMIT = 1e18


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _col(c).try_cast(MONEY_TYPE)


def in_range(c) -> Column:
    """Absent, or a number below ``MONEY_LIMIT`` in size (NaN is not)."""
    return _col(c).isNull() | (F.abs(_col(c)) < MONEY_LIMIT)


def money_sum(c) -> Column:
    """Exact sum. Values that are no number, or beyond ``MONEY_TYPE``, are left out, and what lies below
    1e-10 counts as 0: the Silver rules quarantine the former (``in_range``), so use it behind them."""
    return F.sum(money(c)).cast("double")
