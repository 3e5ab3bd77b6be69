"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps carry no zone; UTC keeps casts to instants free of clock changes.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# For large inputs: start with many small shuffle partitions and let Spark merge
# them to the advised size, so that the plate joins fit into executor memory.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "voltatlas", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the jobs rely on; off a local master also those for large inputs."""
    builder = SparkSession.builder.appName(app)
    local = (master or "").startswith("local")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **({} if local else CLUSTER_SETTINGS), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may go without
    that setting; a cluster without it is an error, because a machine's own
    temporary folder is lost with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        base = tempfile.mkdtemp(prefix="voltatlas-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
