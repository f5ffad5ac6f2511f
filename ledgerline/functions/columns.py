"""Column-name harmonization.

Name resolution happens once on the driver against ``df.columns`` (plan
metadata); the per-row work is a single ``coalesce`` in the projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted raw spellings per canonical field, after name
# normalization. Order is the preference order for ``alias_mode="first_column"``.
ALIASES: dict[str, dict[str, tuple[str, ...]]] = {
    "customers": {
        "customer_id": ("customer_id", "customerid", "cust_id", "customer_identifier"),
        "customer_email": ("customer_email", "email", "email_address"),
        "customer_name": ("customer_name", "name", "full_name"),
    },
    "transactions": {
        "order_id": ("order_id", "orderid"),
        "product_id": ("product_id", "productid"),
    },
    "returns": {
        "order_id": ("order_id", "orderid"),
        "refund_amount": ("refund_amount", "amount"),
        "return_status": ("return_status", "status"),
        "return_date": ("date_of_return", "return_date"),
    },
    "products": {
        "product_id": ("product_id", "productid"),
    },
    "vendors": {
        "vendor_id": ("vendor_id", "vendorid"),
    },
}


def normalize_name(name: str) -> str:
    """strip → lower → spaces to underscores."""
    return name.strip().lower().replace(" ", "_")


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Snake-case every column name. Two raw headers that normalize to the same
    name (``Customer ID`` and ``customer_id``) are merged with ``coalesce`` in
    their original order instead of producing an ambiguous reference."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        groups.setdefault(normalize_name(c), []).append(c)
    if all(len(v) == 1 for v in groups.values()):
        return df.toDF(*[normalize_name(c) for c in df.columns])
    return df.select(
        *[
            (quoted(src[0]) if len(src) == 1 else F.coalesce(*[quoted(s) for s in src])).alias(name)
            for name, src in groups.items()
        ]
    )


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column if present, else a typed NULL (never a void column)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def resolve_alias(df: DataFrame, names: Sequence[str], mode: str = "coalesce", dtype: str = "string") -> Column:
    """Pick a field from its alias columns.

    ``coalesce`` (default): first non-NULL value per row across every alias
    column that exists, so one Bronze table holding several regions' spellings
    keeps all ids. ``first_column``: the first alias column that exists,
    whatever its values (parity with the reference)."""
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(None).cast(dtype)
    if mode == "first_column" or len(present) == 1:
        return F.col(present[0]).cast(dtype)
    if mode != "coalesce":
        raise ValueError(f"unknown alias mode {mode!r}")
    return F.coalesce(*[F.col(n).cast(dtype) for n in present])


def harmonize(df: DataFrame, entity: str, mode: str = "coalesce") -> DataFrame:
    """Add every canonical field of ``entity`` from its aliases, in one projection."""
    spec = ALIASES.get(entity, {})
    return df.withColumns({field: resolve_alias(df, names, mode) for field, names in spec.items()})
