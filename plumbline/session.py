"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Instants are compared in UTC; a repeated JSON key keeps its last value.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Batches handed to Python hold whole texts, so they are bounded in bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to an existing session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    ``spark.checkpoint.dir`` names it. Only where that is unset and the session
    is a local one does a temporary folder stand in; on a cluster the executors
    would not see it.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="plumbline-ckpt-")
    context.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """A small table computed now and kept in the checkpoint folder.

    What follows reads the few rows instead of running the scans behind them
    again, and still can after an executor is lost.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
