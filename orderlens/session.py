"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that decide plan quality; sizes of partitions come from AQE, which
# splits and merges shuffle partitions towards the advisory size at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "orderlens", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session. On a cluster leave ``master`` unset and let spark-submit choose it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> None:
    """Zone-free timestamps are read as UTC everywhere in this library."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster without it is an error, because a driver-local path would be lost.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"orderlens-{os.getuid()}")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/orderlens/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def reliable_checkpoint(df):
    """Cut lineage with a checkpoint on shared storage, which outlives lost executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
