"""Persisted schema of a Bronze entity (S5, S6): columns and the narrowest type that
all their values so far have, one version per change.

Bronze keeps the raw text. Each batch is looked through once, by one aggregate, for the
types its values fit; a type only ever widens:

    void → boolean → string
    void → bigint → double → string
    void → date → timestamp_ntz → string

A reader takes the columns from the newest version, without a look at any file's footer, and
``typed`` casts them. Digits with leading zeros stay text: they are identifiers.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..sources.versions import absent

PROVENANCE = {"source_file": StringType(), "ingestion_timestamp": TimestampType()}
VOID, TEXT = "void", "string"
WIDER = {"boolean": TEXT, "bigint": "double", "double": TEXT, "date": "timestamp_ntz", "timestamp_ntz": TEXT}

_DATE, _TIME = r"\d{4}-\d{2}-\d{2}", r"[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"
_PATTERNS = {
    "boolean": "(?i)^(true|false)$",
    "bigint": r"^-?(0|[1-9]\d{0,17})$",
    "double": r"^-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$",
    "date": f"^{_DATE}$",
    "timestamp_ntz": f"^{_DATE}({_TIME})?$",
}


def fits(c: Column, kind: str) -> Column:
    """The text is a value of the type."""
    return c.rlike(_PATTERNS[kind]) & c.try_cast(kind).isNotNull()


_BIT = {kind: 1 << i for i, kind in enumerate(_PATTERNS)}
_STARTS = r"^[-0-9tTfF]"  # of any value that is not text


def _beyond(c: Column, tried: list[str]) -> Column:
    """One bit for each of the ``tried`` types that the text is not a value of; NULL stays NULL.
    Patterns are looked at in turn, and only as far as a value needs."""
    bits = lambda kinds: sum(_BIT[k] for k in tried if k not in kinds)
    out = F.when(c.isNull(), F.lit(None).cast("int")).when(~c.rlike(_STARTS), F.lit(bits(())))
    # what fits a type's column fits the wider ones' too
    holds = {"bigint": ("bigint", "double"), "double": ("double",), "date": ("date", "timestamp_ntz"), "timestamp_ntz": ("timestamp_ntz",), "boolean": ("boolean",)}
    for kind, kinds in holds.items():
        if kind in tried:
            out = out.when(fits(c, kind), F.lit(bits(kinds)))
    return out.otherwise(F.lit(bits(())))


def widen(a: str, b: str) -> str:
    """The narrowest type that holds both."""
    if VOID in (a, b):
        return b if a == VOID else a
    return next(kind for kind in _wider(a) if kind in _wider(b))


def _wider(kind: str) -> list[str]:
    """A type and those it can widen to."""
    return [kind] if kind == TEXT else [kind, *_wider(WIDER[kind])]


def infer(rows: DataFrame, known: dict[str, str] | None = None) -> dict[str, str]:
    """Column → type of its values, by one aggregate over the rows. For a column whose
    type is ``known`` (by lower-case name), only that and wider ones are tried: text needs no look."""
    known = known or {}
    names = [c for c in rows.columns if c not in PROVENANCE and c != "batch_id"]
    col = lambda c: F.col(f"`{c}`")
    tried = {c: list(_PATTERNS) if known.get(c.lower(), VOID) == VOID else _wider(known[c.lower()])[:-1] for c in names}
    # a column of text is only asked for a value at all, to tell it from one without
    asked = [F.bit_or(_beyond(col(c), tried[c]) if tried[c] else F.when(col(c).isNotNull(), F.lit(0))).alias(str(i)) for i, c in enumerate(names)]
    found = rows.agg(*asked).first() if names else None
    out = {}
    for i, c in enumerate(names):
        out[c] = VOID if found[str(i)] is None else next((k for k in tried[c] if not found[str(i)] & _BIT[k]), TEXT)
    return out


class SchemaLog:
    """Versions of an entity's columns below ``{bronze}/_schemas/{entity}``."""

    def __init__(self, spark: SparkSession, bronze: str, entity: str):
        self.spark, self.path = spark, f"{bronze.rstrip('/')}/_schemas/{entity}/versions"
        self.version, self.types = -1, {}
        try:
            log = spark.read.parquet(self.path)
        except AnalysisException as e:
            if not absent(e):
                raise
            return
        newest = log.agg(F.max("version")).first()[0]
        rows = sorted(log.where(F.col("version") == newest).collect(), key=lambda r: r["place"])
        self.version, self.types = int(newest), {r["name"]: r["type"] for r in rows}

    def record(self, rows: DataFrame) -> bool:
        """Widens the schema by a batch of raw rows; True if that made a new version."""
        found = infer(rows, {c.lower(): t for c, t in self.types.items()})
        # names that differ in case alone are one column, as for every reader
        own = {c.lower(): t for c, t in found.items()}
        merged = {c: widen(t, own.pop(c.lower(), VOID)) for c, t in self.types.items()} | {c: t for c, t in found.items() if c.lower() in own and c not in self.types}
        if merged == self.types and self.version >= 0:
            return False
        listed = pa.Table.from_pylist([{"place": i, "name": c, "type": t} for i, (c, t) in enumerate(merged.items())])
        self.spark.createDataFrame(listed).coalesce(1).write.parquet(f"{self.path}/version={self.version + 1}")
        self.version, self.types = self.version + 1, merged
        return True

    def text_schema(self) -> StructType:
        """What the files hold: text, and provenance."""
        return StructType([StructField(c, StringType()) for c in self.types] + [StructField(c, t) for c, t in PROVENANCE.items()])

    def typed(self, rows: DataFrame) -> DataFrame:
        """Raw rows with the logged types; every value was seen to fit."""
        cast = [F.col(f"`{c}`").try_cast(t if t != VOID else TEXT).alias(c) for c, t in self.types.items()]
        return rows.select(*cast, *[c for c in rows.columns if c in PROVENANCE])
