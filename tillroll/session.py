"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

# AQE sizes the shuffle partitions at run time, splits hot join and rebalance partitions,
# and broadcasts a side only after seeing its size. The session time zone pins the one
# place where a timestamp becomes a calendar day.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tillroll-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; a retry never meets the files of a failed try."""
    return f"{shared_folder(spark)}/{label}-{uuid4().hex}"
