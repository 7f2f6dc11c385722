"""Session settings the package relies on, and the shared folder for data that cuts a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Options to build a session with. ANSI mode gives failing casts, the adaptive options split hot join keys
# and size shuffle partitions at run time, the cleaner drops checkpoint files nobody refers to any more.
OPTIONS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def require_ansi(df: DataFrame) -> DataFrame:
    """Refuse a session in which a failing cast would quietly give NULL."""
    if df.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("strict casts need spark.sql.ansi.enabled=true")
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tillbook-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder; partition numbers and row order stay fixed from then on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
