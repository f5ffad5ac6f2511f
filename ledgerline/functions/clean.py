"""Value standardization (Q1–Q10). Every function maps Column → Column with
built-in expressions, so they stay inside whole-stage codegen. Dirty text never
raises under ANSI mode: parsing uses ``try_*`` and yields NULL instead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code → label maps and accepted formats.
SEGMENT_CODES = {"CONS": "Consumer"}
VALID_SEGMENTS = ("Consumer", "Corporate", "Home Office")
FIRST_CLASS_SPELLINGS = ("1st Class", "First Class")
RETURN_STATUS_CODES = (
    ("Rejected", ("REJECTED", "RJCTD")),
    ("Approved", ("APPROVED", "APPRVD")),
    ("Pending", ("PENDING", "PENDG")),
)
ORDER_TS_FORMATS = ("MM/dd/yyyy HH:mm", "yyyy-MM-dd HH:mm")
RETURN_DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy")


def as_text(c: Column) -> Column:
    return c.cast("string")


def segment_label(c: Column) -> Column:
    """``CONS`` → ``Consumer``; anything else unchanged (Q1)."""
    out = c
    for code, label in SEGMENT_CODES.items():
        out = F.when(c == code, F.lit(label)).otherwise(out)
    return out


def ship_mode_label(c: Column) -> Column:
    """``1st Class`` / ``First Class`` → ``First Class`` (Q2)."""
    return F.when(c.isin(*FIRST_CLASS_SPELLINGS), F.lit("First Class")).otherwise(c)


def return_status_label(raw_upper: Column) -> Column:
    """Upper-cased status code → label, NULL/other → ``Unknown`` (Q3)."""
    out = None
    for label, codes in RETURN_STATUS_CODES:
        out = F.when(raw_upper.isin(*codes), F.lit(label)) if out is None else out.when(raw_upper.isin(*codes), F.lit(label))
    return out.otherwise(F.lit("Unknown"))


def percent_to_fraction(c: Column, mode: str = "percent_aware") -> Column:
    """Discount text → fraction (Q4).

    ``percent_aware`` divides by 100 only when the text holds a literal ``%``
    (``40%`` → 0.4, ``0.4`` → 0.4). ``as_written`` keeps the reference's
    ``LIKE '%'`` test, which matches every non-NULL string."""
    text = as_text(c)
    stripped = F.regexp_replace(text, "%", "").try_cast("double")
    if mode == "percent_aware":
        is_percent = text.contains("%")
    elif mode == "as_written":
        is_percent = text.like("%")
    else:
        raise ValueError(f"unknown discount mode {mode!r}")
    return F.when(is_percent, stripped / F.lit(100.0)).otherwise(text.try_cast("double"))


def currency_to_double(c: Column) -> Column:
    """Strip ``$`` and parse; thousands separators or junk → NULL (Q5)."""
    return F.regexp_replace(as_text(c), "[$]", "").try_cast("double")


def parse_timestamp(c: Column, formats: Sequence[str] = ORDER_TS_FORMATS) -> Column:
    """First format that parses wins; unparseable → NULL (Q6). Wall-clock
    timestamps without zone, as the raw text carries none."""
    text = as_text(c)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def parse_date(c: Column, formats: Sequence[str] = RETURN_DATE_FORMATS) -> Column:
    """Multi-format date (Q7)."""
    text = as_text(c)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("date")


def upc_digits(c: Column) -> Column:
    """Scientific-notation id → plain digits: ``6.40E+11`` → ``640000000000``
    (Q8). NULL or unparseable stays NULL (``%.0f`` of NULL would be ``''``)."""
    value = as_text(c).try_cast("double")
    return F.when(value.isNotNull(), F.format_string("%.0f", value))


def title_case(c: Column) -> Column:
    """``initcap``: words split on spaces only (Q9)."""
    return F.initcap(c)


def to_int(c: Column) -> Column:
    """Whole-number text → int: ``2`` and ``2.0`` → 2; ``3.7``, ``abc`` → NULL (Q10)."""
    text = as_text(c)
    number = text.try_cast("decimal(38,10)")
    # the decimal reading only where the plain one gives nothing
    return F.coalesce(text.try_cast("int"), F.when(number == F.floor(number), number.try_cast("int")))


def to_double(c: Column) -> Column:
    return as_text(c).try_cast("double")
