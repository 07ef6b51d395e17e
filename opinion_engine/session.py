"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from . import files

# What the operators rely on. Partition counts and memory belong to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CHECKPOINT_DIR = "spark.checkpoint.dir"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder, which goes when Python ends.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if not root:
            if not context.master.startswith("local"):
                raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="opinion-engine-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
            context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner a true size. What the write has shuffled is
    freed at its end. ``discard`` frees the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["scratch"] = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing will read any more."""
    files.delete(df.sparkSession, df.__dict__["scratch"])
