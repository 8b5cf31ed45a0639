"""Shared storage for intermediate tables.

Loops cut their lineage by writing each step as a Parquet table below the folder
the cluster names in ``spark.checkpoint.dir``. A written table survives the loss
of any executor, is read back with column pruning, and gives the planner its true
size, so a broadcast is chosen only when that size is under the threshold.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The configured folder; on a local master only, a temporary one if unset."""
    context = spark.sparkContext
    configured = spark.conf.get(CONF, None) or context.getConf().get(CONF)
    if configured:
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CONF} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="snowlit-"))
    return context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run of a job."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_step(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and return it read back from there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
