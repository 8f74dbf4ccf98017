"""Cutting lineage so that a lost executor never costs more than one stage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder; a cluster must name its own,
    because no executor sees the driver's disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="grainsieve-")
    context.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for tables written and read back."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
