"""Spark session settings and the shared checkpoint folder.

Everything here is plain Spark configuration. The library never creates
its own session on a cluster: callers pass one in. ``local_session`` is for
tests, the bench and the driver smoke check.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans at runtime: it coalesces small
# shuffle partitions, turns a join into a broadcast only when the measured
# side is below the threshold, and splits skewed join partitions so one hot
# key (up to a third of all rows) is spread over several tasks. A task that writes into a
# few folders keeps a writer open for each instead of sorting its rows by folder first.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benches (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.files.maxPartitionBytes", "64m")
    )
    active = SparkSession.getActiveSession()
    if active is None or not checkpoint_dir(active):
        # tests only: the cluster names its own shared folder
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerline-warehouse-"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the runtime settings that the session does not set itself."""
    own = spark.conf.getAll
    for k, v in RUNTIME_CONF.items():
        if k not in own:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; set one of our own only when unset
    (local tests), never overriding what the cluster provides."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors (e.g. on the cluster's object store)")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
