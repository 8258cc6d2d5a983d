"""Where intermediate files go: the shared folder the cluster names, never an executor's own disk."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only when running in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return tempfile.gettempdir()
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def new_stage(spark: SparkSession, label: str) -> str:
    """A fresh folder name for one run."""
    return f"{shared_root(spark)}/tallymart/{label}-{uuid.uuid4().hex[:12]}"
