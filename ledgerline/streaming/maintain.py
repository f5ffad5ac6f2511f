"""Gold kept up to date by deltas, without streaming state.

Each class applies one micro-batch of new Silver rows to a ``VersionedTable`` and commits the
result, with the batch's number, in one manifest: a batch that is run again after
a failure is recognized and adds nothing, and one that failed half way left nothing in
force.

* ``DeltaJoin``: facts. New x (old and new) and old x new rows of the two sides, which
  are kept by bucket of the join key; the joins are plain batch joins, so a hot key is
  split by AQE and a late match is never lost. Only the buckets of the new keys are read.
* ``KeyedTable``: dimensions. The survivors of a batch are merged into the buckets
  of their keys; other buckets stay as they are.
* ``MergedAggregate``: KPIs. Sums and counts of the new facts are added to the stored ones
  of their keys; distinct counts stay exact by the (key, value) pairs seen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import latest_by_key
from ..sources.versions import ROWS, Entry, VersionedTable, bucket_of


def _touched(entries: Sequence[Entry]) -> set[int]:
    return {e.bucket for e in entries if e.n_rows}


def _buckets(rows: DataFrame, keys: Sequence[str], table: VersionedTable) -> set[int]:
    """The buckets that the rows fall into: at most as many numbers as the table has buckets."""
    bucket = bucket_of(keys, table.buckets) if table.buckets > 1 else F.lit(0)
    return {r[0] for r in rows.select(bucket).distinct().collect()}


def _either(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
    return a if b is None else b if a is None else a.unionByName(b)


class DeltaJoin:
    """``join(left, right)``, an inner equi-join on ``key``, of two tables that grow."""

    def __init__(self, table: VersionedTable, key: str, join: Callable[[DataFrame, DataFrame], DataFrame]):
        self.table, self.key, self.join = table, key, join

    def apply(self, left: DataFrame, right: DataFrame, batch: int) -> DataFrame | None:
        """The facts that this batch adds (None: none); applied once, however often it is run."""
        t = self.table
        if batch > t.batch:
            sides = {"left": left, "right": right}
            # written first: the batch's source is read once, and what is joined is what is kept
            new = {s: t.write(df.where(F.col(self.key).isNotNull()), s, [self.key]) for s, df in sides.items()}
            was = list(t.entries)
            t.entries = was + new["left"] + new["right"]
            fresh = {s: t.read(s, folders={e.folder for e in new[s]}) if _touched(new[s]) else None for s in sides}
            t.entries = was
            old = {s: t.read(s, _touched(new["right" if s == "left" else "left"])) for s in sides}
            # new x (old and new) and old x new, so that the larger new side is joined, and shuffled, only once
            count = {s: sum(e.n_rows for e in new[s]) for s in sides}
            once, twice = ("left", "right") if count["left"] > count["right"] else ("right", "left")
            pairs = [(fresh[once], _either(old[twice], fresh[twice])), (old[once], fresh[twice])]
            parts = [self.join(*((a, b) if once == "left" else (b, a))) for a, b in pairs if a is not None and b is not None]
            added = t.write(reduce(DataFrame.unionByName, parts)) if parts else []
            t.commit(was + new["left"] + new["right"] + added, batch)
            for side in sides:
                t.compact(side)
        prefix = f"v={self._version_of(batch):08d}-"
        mine = {e.folder for e in t.entries if e.part == ROWS and e.n_rows and e.folder.startswith(prefix)}
        return t.read(folders=mine) if mine else None

    def _version_of(self, batch: int) -> int:
        """The version that committed a batch (the batch in hand is the last or the one before a restart)."""
        log = self.table.spark.read.parquet(f"{self.table.root}/_log/versions")
        return log.where(F.col("batch") == batch).agg(F.min("version")).first()[0]


class KeyedTable:
    """One row a key: the greatest by ``order`` (then by the other columns)."""

    def __init__(self, table: VersionedTable, keys: Sequence[str], order: Sequence[str] = ()):
        self.table, self.keys, self.order = table, list(keys), list(order)

    def upsert(self, rows: DataFrame, batch: int) -> None:
        t = self.table
        if batch <= t.batch:
            return
        survivors = latest_by_key(rows, self.keys, self.order)
        if not t.exists:
            t.commit(t.write(survivors, keys=self.keys), batch)
            return
        touched = _buckets(rows, self.keys, t)
        if not touched:
            t.commit(t.entries, batch)
            return
        merged = t.write(latest_by_key(_either(t.read(buckets=touched), survivors), self.keys, self.order), keys=self.keys)
        t.commit([e for e in t.entries if not (e.part == ROWS and e.bucket in touched)] + merged, batch)

    def read(self) -> DataFrame | None:
        return self.table.read()


class MergedAggregate:
    """Count of rows, sums, and distinct values of one column by key.

    ``sums`` maps names to columns that add up exactly (DECIMAL or whole numbers),
    ``derived`` names columns that are worked out of the facts first."""

    def __init__(self, table: VersionedTable, keys: Sequence[str], sums: dict[str, Column] | None = None, distinct: str | None = None, derived: dict[str, Column] | None = None):
        self.table, self.keys, self.sums, self.distinct, self.derived = table, list(keys), dict(sums or {}), distinct, dict(derived or {})

    def _merge(self, df: DataFrame) -> DataFrame:
        typed = {f.name: f.dataType for f in df.schema}
        added = [F.sum(c).cast(typed[c]).alias(c) for c in ("n_rows", *self.sums, "n_distinct")]
        return df.groupBy(*self.keys).agg(*added)

    def apply(self, delta: DataFrame | None, batch: int) -> None:
        t = self.table
        if batch <= t.batch:
            return
        if delta is None:
            t.commit(t.entries, batch)
            return
        was, seen = list(t.entries), []
        delta = delta.withColumns(self.derived)
        sums = [F.sum(c).alias(name) for name, c in self.sums.items()]
        partial = delta.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_rows"), *sums, F.lit(0).cast("long").alias("n_distinct"))
        if self.distinct:
            pairs = delta.select(*self.keys, self.distinct).where(F.col(self.distinct).isNotNull()).distinct()
            asked = delta.where(F.col(self.distinct).isNotNull())
            known = t.read("seen", _buckets(asked, [self.distinct], t)) if any(e.part == "seen" for e in t.entries) else None
            if known is not None:
                old = known.select(*[F.col(c).alias(f"_{c}") for c in (*self.keys, self.distinct)])
                same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*self.keys, self.distinct)])
                pairs = pairs.join(old, same, "left_anti")
            seen = t.write(pairs, "seen", [self.distinct])
            t.entries = was + seen
            fresh = t.read("seen", folders={e.folder for e in seen}) if _touched(seen) else None
            t.entries = was
            if fresh is not None:
                none = [F.lit(None if c in self.sums else 0).cast(partial.schema[c].dataType).alias(c) for c in ("n_rows", *self.sums)]
                counted = fresh.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_distinct")).select(*self.keys, *none, "n_distinct")
                partial = partial.unionByName(counted)
        stored, touched = None, set()
        if t.read() is not None:
            touched = _buckets(delta, self.keys, t)  # by the facts' keys: nothing is added up for it
            stored = t.read(buckets=touched)
        # what is stored, the new rows' sums and their distinct counts are added up by one shuffle
        merged = t.write(self._merge(_either(stored, partial)), keys=self.keys) if touched or stored is None else []
        t.commit([e for e in was if not (e.part == ROWS and e.bucket in touched)] + seen + merged, batch)
        t.compact("seen")

    def read(self) -> DataFrame | None:
        return self.table.read()
