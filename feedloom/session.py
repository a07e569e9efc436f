"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Only settings that hold at any scale. Shuffle width, memory and parallelism
# belong to the cluster; AQE then coalesces or splits to fit the data.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Deduplication state may outgrow memory; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app: str = "feedloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per Spark application."""
    sc = spark.sparkContext
    if not getattr(sc, "_feedloom_shipped", False):
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="feedloom-")) / "feedloom"
        archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
        sc.addPyFile(archive)
        sc._feedloom_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    session without it is refused, because a machine-local folder would lose
    data with its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="feedloom-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/feedloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote with ``scratch_path``; for the end of
    a job, when no frame reads from it any more."""
    delete_path(spark, _scratch_root(spark))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer used. It does so
    when the driver collects its garbage, which a mostly idle driver may put off for
    half an hour."""
    for _ in range(2):  # a frame may hold another one's last reference
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def materialize(df: DataFrame, name: str = "step", path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one expensive result feeds several outputs: unlike a cache it
    survives the loss of executors, and readers prune its columns. Callers that give
    the ``path`` delete it when nothing reads it any more.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
