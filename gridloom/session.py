"""Session settings, the shared scratch folder and tables written there for a while."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Correct at any size; sizes (memory, executors) belong to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Executors may be lost: let shuffle files move away from a node that is going.
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def get_session(app_name: str = "gridloom", master: str | None = None, **extra: str) -> SparkSession:
    """Build a session; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="gridloom-")
    return f"{shared.rstrip('/')}/gridloom-{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared ``spark.checkpoint.dir`` and read again.

    Cuts the lineage in storage that every executor reaches. The folder goes with
    :func:`unstage`, or when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    atexit.register(remove, spark, path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._staged_at = path
    return kept


def unstage(*frames: DataFrame) -> None:
    """Removes the folders of staged frames, once all that reads them has been written."""
    for frame in frames:
        remove(frame.sparkSession, frame._staged_at)
    release(frames[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Asks the driver's two collectors to run, upon which Spark drops the shuffle files of finished
    jobs. Plans are kept alive by cycles of Python objects, so Python's comes first."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # already stopped
        return
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
