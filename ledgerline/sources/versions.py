"""Versioned tables (K5, K6, K9, K10): new rows go to new folders, and one small
manifest file, written last, says which folders are in force.

A write that fails leaves the manifest, and so every reader, with the rows of before;
what it left behind is never read. Nothing in force is overwritten or moved, so the
layout needs no rename beyond Spark's own file commit. One writer at a time is assumed; a
second one that commits the same version fails.

Layout below ``root``: ``v=<version>/bucket=<b>/*.parquet`` holds the table's rows,
``_<part>/v=<version>/bucket=<b>`` further parts kept beside them (hidden from a plain
read of ``root``), ``_log/versions/version=<n>`` the manifests.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.types import IntegerType, StructField, StructType

ROWS = "rows"  # the part that is the table itself
FEW_BUCKETS = 16  # up to as many, a task keeps a file of each open (``maxConcurrentOutputFileWriters``)
COMPRESSION = "zstd"
MANIFEST = pa.schema(
    [("part", pa.string()), ("folder", pa.string()), ("bucket", pa.int32()), ("n_rows", pa.int64()), ("schema", pa.string()), ("batch", pa.int64()), ("buckets", pa.int32())]
)


@dataclass(frozen=True)
class Entry:
    """One bucket of one written folder; without rows it only keeps the part's schema."""

    part: str
    folder: str
    bucket: int
    n_rows: int
    schema: str


def bucket_of(keys: Iterable[str], buckets: int) -> Column:
    """Bucket of a key; a NULL key has one too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def absent(e: AnalysisException) -> bool:
    """The path is not there, or holds no file yet."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 1):
        self.spark, self.root = spark, root.rstrip("/")
        self.version, self.batch, self.buckets, self.entries = -1, -1, buckets, []
        self.refresh()

    def refresh(self) -> "VersionedTable":
        """Reads the newest manifest; a version whose manifest is incomplete does not count."""
        try:
            log = self.spark.read.parquet(f"{self.root}/_log/versions")
        except AnalysisException as e:
            if not absent(e):
                raise
            return self
        newest = log.agg(F.max("version")).first()[0]
        rows = log.where(F.col("version") == newest).collect()  # one row a bucket and folder in force
        self.version, self.batch, self.buckets = int(newest), rows[0]["batch"], rows[0]["buckets"]
        self.entries = [Entry(r["part"], r["folder"], r["bucket"], r["n_rows"], r["schema"]) for r in rows if r["folder"]]
        return self

    @property
    def exists(self) -> bool:
        return self.version >= 0

    # ---- reading ----------------------------------------------------------------------
    def _base(self, part: str) -> str:
        return self.root if part == ROWS else f"{self.root}/_{part}"

    def read(self, part: str = ROWS, buckets: Iterable[int] | None = None, folders: Iterable[str] | None = None) -> DataFrame | None:
        """The rows in force, of some buckets or folders only if given; None if the part was never written."""
        wanted = None if buckets is None else set(buckets)
        only = None if folders is None else set(folders)
        mine = [e for e in self.entries if e.part == part]
        if not mine:
            return None
        schema = StructType.fromJson(json.loads(mine[-1].schema))
        chosen = [e for e in mine if e.n_rows and (wanted is None or e.bucket in wanted) and (only is None or e.folder in only)]
        if not chosen:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self._base(part)}/{e.folder}/bucket={e.bucket}" for e in chosen]
        return self.spark.read.schema(schema).parquet(*paths)

    # ---- writing ----------------------------------------------------------------------
    def write(self, df: DataFrame, part: str = ROWS, keys: Iterable[str] = ()) -> list[Entry]:
        """Writes rows to a new folder by bucket of ``keys`` and checks that they can be
        read back; they count once the entries are committed."""
        folder = f"v={self.version + 1:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{self._base(part)}/{folder}"
        seen = Observation(f"rows-{folder}")
        out = self._bucketed(df, keys)
        # observed in the writing stage itself, where a task that is run again counts once
        out.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", COMPRESSION).partitionBy("bucket").parquet(path)
        wrote, schema = int(seen.get["n"]), df.schema.json()
        if not wrote:
            return [Entry(part, folder, 0, 0, schema)]
        found = self.spark.read.parquet(path).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        if sum(r["n"] for r in found) != wrote:
            raise OSError(f"{path}: {wrote} rows were written, {sum(r['n'] for r in found)} can be read")
        return [Entry(part, folder, r["bucket"], r["n"], schema) for r in found]

    def _bucketed(self, df: DataFrame, keys: Iterable[str]) -> DataFrame:
        """Rows with their bucket. A few buckets are written by every task, which spares a shuffle of all rows; of
        many, each is brought together first: few files a bucket, and AQE splits one that is large."""
        out = df.withColumn("bucket", bucket_of(keys, self.buckets) if keys and self.buckets > 1 else F.lit(0))
        return out.hint("rebalance", F.col("bucket")) if keys and self.buckets > FEW_BUCKETS else out

    def commit(self, entries: Iterable[Entry], batch: int | None = None) -> None:
        """Puts exactly these entries in force (the switch)."""
        full = {e.part for e in entries if e.n_rows}
        entries = [e for e in entries if e.n_rows or e.part not in full]
        batch = self.batch if batch is None else batch
        rows = [asdict(e) | {"batch": batch, "buckets": self.buckets} for e in entries] or [{"batch": batch, "buckets": self.buckets}]
        path = f"{self.root}/_log/versions/version={self.version + 1}"
        self.spark.createDataFrame(pa.Table.from_pylist(rows, MANIFEST)).coalesce(1).write.parquet(path)
        self.version, self.batch, self.entries = self.version + 1, batch, entries

    def replace(self, df: DataFrame, batch: int | None = None) -> int:
        """The whole table anew (K5, K6): readers see the old rows until the switch, then the new ones."""
        new = self.write(df)
        self.commit([e for e in self.entries if e.part != ROWS] + new, batch)
        return sum(e.n_rows for e in new)

    def clear(self) -> None:
        """Empties the table (K9); its earlier folders stay, for readers that still hold them."""
        if self.read() is not None:
            self.replace(self.read().where(F.lit(False)))

    def compact(self, part: str, most: int = 32) -> None:
        """Rewrites the buckets of an appended part that lie in more than ``most`` folders;
        a bucket is rewritten once in ``most`` appends."""
        count: dict[int, int] = {}
        for e in self.entries:
            if e.part == part:
                count[e.bucket] = count.get(e.bucket, 0) + 1
        full = {b for b, n in count.items() if n > most}
        if full:
            schema = next(e.schema for e in reversed(self.entries) if e.part == part)
            path = f"v={self.version + 1:08d}-{uuid.uuid4().hex[:8]}"
            base = self._base(part)
            paths = [f"{base}/{e.folder}/bucket={e.bucket}" for e in self.entries if e.part == part and e.bucket in full and e.n_rows]
            fields = StructType.fromJson(json.loads(schema)).fields
            rows = self.spark.read.schema(StructType([*fields, StructField("bucket", IntegerType())])).option("basePath", base).parquet(*paths)
            rows.hint("rebalance", F.col("bucket")).write.option("compression", COMPRESSION).partitionBy("bucket").parquet(f"{base}/{path}")
            found = self.spark.read.parquet(f"{base}/{path}").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
            new = [Entry(part, path, r["bucket"], r["n"], schema) for r in found]
            if sum(e.n_rows for e in new) != sum(e.n_rows for e in self.entries if e.part == part and e.bucket in full):
                raise OSError(f"{base}/{path}: compacted rows differ in number")
            self.commit([e for e in self.entries if not (e.part == part and e.bucket in full)] + new)


def publish(spark: SparkSession, df: DataFrame, view: str, root: str) -> int:
    """Replaces the table at ``root`` and points the catalog view at the new folder.
    The view's definition changes in one catalog call, after the rows are checked."""
    table = VersionedTable(spark, root)
    n = table.replace(df)
    folder = table.entries[-1].folder
    names = ", ".join(f"`{c}`" for c in df.columns)
    if n:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {names} FROM parquet.`{table.root}/{folder}`")
    else:
        typed = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema)
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {typed} WHERE false")
    return n
