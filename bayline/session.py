"""Session settings and shared scratch storage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. UTC keeps date arithmetic equal on all hosts; the adaptive
# settings let Spark split skewed join partitions even when that costs an extra shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Joins shuffle by all their keys, salts included; plans over the star take this back.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # Streaming state on local disk with checkpoints, so that it may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# For sessions built here only, since they are read when a session starts.
STARTUP_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # No call-site capture for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_LOCAL_SCRATCH = "bayline.scratch.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "bayline", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the settings above; `master` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {
        **RUNTIME_SETTINGS,
        **STARTUP_SETTINGS,
        **extra,
    }.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the one the cluster names in spark.checkpoint.dir.

    A folder is made up only for a local session that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL_SCRATCH, None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="bayline-")
    spark.conf.set(_LOCAL_SCRATCH, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root; never reused, so a rerun cannot read stale data."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes inside give back the disk of their shuffles as they end, not when the driver happens to collect garbage.

    For writes only: each plans its frame for itself, so nothing else reads those shuffles.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


# For large tables of text that are written once and read a few times.
COMPACT = "zstd"


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a frame to the scratch folder and read it back.

    This cuts the lineage at a durable table: a lost executor re-reads files instead of
    recomputing, and Catalyst plans later joins from the real size of the data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_freed(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
