"""Shared folder for checkpoints and written tables, and broadcast of checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A lookup side larger than this is joined by shuffle instead of being broadcast.
BROADCAST_BYTES = 256 * 1024 * 1024
# What a row and a cell cost besides their text.
ROW_BYTES, CELL_BYTES = 32, 16


def workspace(spark: SparkSession) -> str:
    """The folder the cluster shares (`spark.checkpoint.dir`).

    Only a local session without that setting gets a temporary folder; a cluster without
    it is a configuration error, since executors cannot see the driver's disk.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tallyport-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write `df` once and go on from the written rows (survives the loss of executors)."""
    workspace(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Settle a lookup side and broadcast it only if it is measured to be small.

    The settled rows are counted and their text added up. Above `limit` bytes the plain
    frame is returned and Spark joins by shuffle.
    """
    settled = settle(df)
    text = F.concat_ws("", *[F.col(c).cast("string") for c in settled.columns])
    size = settled.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("text")
    ).first()
    measured = size.text + size["rows"] * (ROW_BYTES + CELL_BYTES * len(settled.columns))
    return F.broadcast(settled) if measured <= limit else settled
