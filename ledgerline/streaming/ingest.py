"""Incremental raw-file ingest into Bronze.

A file stream of *paths* (``binaryFile`` with ``content`` pruned, so no bytes
are read by the stream itself) gives exactly-once discovery through its
checkpoint. Each micro-batch then reads its new files:

* CSV files are grouped by their header line (one split-parallel pass of the JVM over
  the new files' text, which lets one line a file through) and each group is read with its own header, so regions spelling
  columns differently (``cust_id`` vs ``Customer ID``) bind by name, never by
  position; groups are unioned by name and a new column simply appears
  (schema evolution).
* JSON files are read with every scalar as text: JSON Lines files with the
  splittable reader (a huge file is many tasks), top-level arrays and
  pretty-printed objects as whole documents (``multiLine``). Bronze keeps
  raw text and Silver does all parsing.

The columns and the types their values fit are kept in a schema log, one version per
change (``schema_log``). Every row gets ``source_file`` and ``ingestion_timestamp``. A batch writes
to ``{bronze}/{entity}/batch_id={n}`` with overwrite, so a batch re-run after
a failure replaces its own output instead of appending twice.
"""

from __future__ import annotations

import csv
import json
import re
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, MapType, StringType, StructField, StructType, TimestampType

from ..session import ensure_checkpoint_dir
from ..sources.versions import COMPRESSION
from .schema_log import SchemaLog

PATHS_SCHEMA = StructType(
    [
        StructField("path", StringType(), False),
        StructField("modificationTime", TimestampType(), False),
        StructField("length", LongType(), False),
        StructField("content", BinaryType(), True),
    ]
)
MAX_FILES_PER_TRIGGER = 1000
RESCUED = "_rescued_data"


@dataclass(frozen=True)
class IngestSpec:
    """One raw entity: where its files land and how they are written."""

    entity: str
    pattern: str  # glob under the landing root, e.g. "Region */customers_*.csv"
    fmt: str  # "csv" or "json"
    name_filter: str | None = None  # pathGlobFilter on file names


# The six raw entities, their landing globs and formats.
DEFAULT_SPECS = (
    IngestSpec("customers", "Region */customers_*.csv", "csv"),
    IngestSpec("orders", "Region */orders_*.csv", "csv"),
    IngestSpec("transactions", "transactions_*.csv", "csv"),
    IngestSpec("products", "*", "json", "products.json"),
    IngestSpec("returns", "returns_*.json", "json"),
    IngestSpec("vendors", "*", "csv", "vendors.csv"),
)


def path_stream(spark: SparkSession, landing: str, spec: IngestSpec, max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming DataFrame of newly landed file paths for one entity."""
    r = spark.readStream.format("binaryFile").schema(PATHS_SCHEMA).option("maxFilesPerTrigger", max_files)
    if spec.name_filter:
        r = r.option("pathGlobFilter", spec.name_filter)
    return r.load(f"{landing.rstrip('/')}/{spec.pattern}").select("path")


def head_lines(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """path → first line of each new file (a bounded list per batch): the CSV
    header, or what tells JSON Lines from a whole JSON document. One job, split by
    size; of each file one row leaves it; an empty file has none."""
    if not paths:
        return {}
    # a session of its own for one setting: no two pieces of files share a partition, so the
    # first row of a partition whose piece starts at 0 is the first line of its file
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    reader.conf.set("spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = reader.read.text([literal_path(p) for p in paths])
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
    first = lines.withColumn("place", F.monotonically_increasing_id() % (1 << 33)).where("place = 0 AND at = 0")
    plain = lambda path: re.sub(r"^file:/+", "/", path)
    found = {plain(unquote(r["path"])): r["value"] for r in first.select("path", "value").collect()}
    return {p: found.get(plain(p)) for p in paths}


def is_json_lines(first: str | None) -> bool:
    """A file whose first line is a complete JSON object holds one object per
    line (splittable); an array or a pretty-printed object is one document."""
    if not first or not first.lstrip().startswith("{"):
        return False
    try:
        return isinstance(json.loads(first), dict)
    except ValueError:
        return False


def literal_path(path: str) -> str:
    """The path with glob characters escaped: landed names are names, not patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def header_names(header: str | list[str]) -> list[str]:
    """Column names of a CSV header or of JSON keys; blank or repeated ones get their position."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header]), []) if isinstance(header, str) else header):
        name = name.strip("\ufeff")
        taken = {n.lower() for n in names} | {RESCUED, "source_file", "ingestion_timestamp"}
        names.append(f"_c{i}" if not name.strip() else f"{name}{i}" if name.lower() in taken else name)
    return names


def with_provenance(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"source_file": F.col("_metadata.file_path"), "ingestion_timestamp": F.current_timestamp()}
    )


def _as_text(df: DataFrame) -> DataFrame:
    keep = {"source_file", "ingestion_timestamp"}
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if f.name not in keep:
            nested = isinstance(f.dataType, (StructType, ArrayType, MapType))
            col = (F.to_json(col) if nested else col.cast("string")).alias(f.name)
        out.append(col)
    return df.select(*out)


def _read_csv(spark: SparkSession, header: str, files: list[str]) -> DataFrame:
    """CSV files with this header. A line with more or fewer fields than the
    header keeps what fits, and its whole text goes to ``_rescued_data``."""
    schema = StructType([StructField(n, StringType()) for n in [*header_names(header), RESCUED]])
    reader = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", RESCUED)
    return reader.csv([literal_path(p) for p in files])


def _read_json_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    return _as_text(with_provenance(spark.read.option("primitivesAsString", True).json([literal_path(p) for p in files])))


def _read_json_documents(spark: SparkSession, files: list[str]) -> DataFrame:
    """Whole documents, an object or an array of objects each, one task a file. Values are kept as
    their JSON text; the column names are the objects' keys in these files. (Spark's own
    inference for whole documents takes file names for patterns once more.)"""
    text = with_provenance(spark.read.text([literal_path(p) for p in files], wholetext=True))
    listed = F.from_json("value", "array<string>")
    items = F.when(F.regexp_replace("value", "^[\\s\ufeff]+", "").startswith("["), F.coalesce(listed, F.array("value"))).otherwise(F.array("value"))
    objects = text.select("source_file", "ingestion_timestamp", F.explode(items).alias("object"))
    objects = objects.where(F.trim("object") != "").withColumn("fields", F.from_json("object", "map<string,string>"))
    keys = sorted(r[0] for r in objects.select(F.explode(F.map_keys("fields"))).distinct().collect())  # the header of these files
    names = header_names(keys)
    rescued = F.when(F.col("fields").isNull(), F.col("object")).alias(RESCUED)  # not an object
    return objects.select(*[F.col("fields")[k].alias(n) for k, n in zip(keys, names, strict=True)], rescued, "source_file", "ingestion_timestamp")


def read_new_files(spark: SparkSession, paths: list[str], fmt: str) -> DataFrame | None:
    """Raw rows of the given files, all values as text, plus provenance."""
    if not paths:
        return None
    if fmt == "json":
        # JSON Lines files are read split-parallel; whole-document files
        # (top-level arrays, pretty-printed objects) need multiLine, one task each
        heads = head_lines(spark, paths)
        modes: dict[bool, list[str]] = {}
        for path, first in heads.items():
            if first is not None:
                modes.setdefault(is_json_lines(first), []).append(path)
        read = {True: _read_json_lines, False: _read_json_documents}
        parts = [read[lines](spark, files) for lines, files in modes.items()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    groups: dict[str, list[str]] = {}
    for path, header in head_lines(spark, paths).items():
        if header is not None:  # empty file: nothing to ingest
            groups.setdefault(header, []).append(path)
    if not groups:
        return None
    parts = [
        _as_text(with_provenance(_read_csv(spark, header, files)))
        for header, files in groups.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    spec: IngestSpec,
    checkpoint_root: str | None = None,
    max_files: int = MAX_FILES_PER_TRIGGER,
):
    """Drain all newly landed files of ``spec`` into Bronze and stop
    (``availableNow``). A rerun with no new files writes nothing."""
    q = start_ingest(spark, landing, bronze, spec, checkpoint_root, max_files)
    q.awaitTermination()
    return q


def start_ingest(spark: SparkSession, landing: str, bronze: str, spec: IngestSpec, checkpoint_root: str | None = None, max_files: int = MAX_FILES_PER_TRIGGER):
    """The same as a running query: entities are ingested side by side."""
    ckpt = f"{(checkpoint_root or ensure_checkpoint_dir(spark)).rstrip('/')}/ingest/{spec.entity}"
    target = f"{bronze.rstrip('/')}/{spec.entity}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # bounded by maxFilesPerTrigger
        rows = read_new_files(batch.sparkSession, paths, spec.fmt)
        if rows is not None:
            path = f"{target}/batch_id={batch_id}"
            rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
            SchemaLog(batch.sparkSession, bronze, spec.entity).record(batch.sparkSession.read.schema(rows.schema).parquet(path))

    return (
        path_stream(spark, landing, spec, max_files)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .queryName(f"ingest_{spec.entity}")
        .start()
    )


def read_bronze(spark: SparkSession, bronze: str, entity: str) -> DataFrame:
    """Bronze table as a batch frame, with the columns of the schema log (missing → NULL);
    without a log, with those of all the files' footers."""
    path = f"{bronze.rstrip('/')}/{entity}"
    log = SchemaLog(spark, bronze, entity)
    reader = spark.read.schema(log.text_schema()) if log.types else spark.read.option("mergeSchema", True)
    return reader.parquet(path).drop("batch_id")


def read_bronze_typed(spark: SparkSession, bronze: str, entity: str) -> DataFrame:
    """Bronze with every column cast to the narrowest type its values so far have."""
    return SchemaLog(spark, bronze, entity).typed(read_bronze(spark, bronze, entity))
