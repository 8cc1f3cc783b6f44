"""Session settings the jobs rely on.

Only settings that change plans are named here; cluster sizing (executors,
memory, ``spark.checkpoint.dir``) belongs to whoever submits the job.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark.sql import DataFrame, SparkSession

PARALLEL_JOBS = 8
PLAN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = "*", app: str = "veilframe", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        # One machine, CPU-heavy stages: do not merge small shuffle blocks into a single task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", os.environ.get("VEILFRAME_DRIVER_MEMORY", "8g"))
    )
    for key, value in PLAN_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_plan_settings(spark: SparkSession) -> SparkSession:
    """Put the plan settings on a session somebody else built."""
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``; only when
    nothing is set (tests, one machine) a temporary folder is used.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="veilframe-checkpoint-")
        context.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/veilframe/{name}-{uuid.uuid4().hex}"


@cache
def _writers() -> ThreadPoolExecutor:
    """Threads that are kept: each has a connection to the JVM, which is slow to close."""
    return ThreadPoolExecutor(max_workers=PARALLEL_JOBS, thread_name_prefix="veilframe-writer")


def materialize(parts: DataFrame | list[DataFrame], name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    Cuts the lineage, so later stages neither recompute the input nor carry its
    plan, and a lost executor re-reads files. The reader also knows the size of
    the files, which lets the planner broadcast on a measured size. A list is
    written as one job per part.
    """
    parts = parts if isinstance(parts, list) else [parts]
    spark, schema = parts[0].sparkSession, parts[0].schema
    path = scratch_path(spark, name)
    paths = [f"{path}/{i}" for i in range(len(parts))]
    if len(parts) == 1:
        parts[0].write.parquet(paths[0])
    else:
        # Independent jobs, so the cluster may run them side by side.
        for done in [_writers().submit(part.write.parquet, at) for part, at in zip(parts, paths)]:
            done.result()
    return spark.read.schema(schema).parquet(*paths)
