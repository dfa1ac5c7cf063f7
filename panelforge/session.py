"""Session builder, lineage cuts and scratch folders."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that suit both a laptop and a large cluster; anything size-related is left to AQE.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "panelforge", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` stays unset on a cluster, where spark-submit names it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or a temp folder in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _LOCAL_FOLDER
    if _LOCAL_FOLDER is None:
        _LOCAL_FOLDER = tempfile.mkdtemp(prefix="panelforge-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDER, ignore_errors=True)
    return _LOCAL_FOLDER


_LOCAL_FOLDER: str | None = None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one run's intermediate table."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and ends the growing plan of a loop."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def sorted_join(side: DataFrame) -> DataFrame:
    """A side that grows with the input: its join sorts both sides and nothing passes through the driver. The planner's guess of an
    exploded or stored table can be far below its size, and a broadcast is put together in the driver."""
    return side.hint("merge")


def spread_out(df: DataFrame) -> DataFrame:
    """Deal rows out evenly where a scan has fewer splits than the session has cores; larger inputs stay where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
