"""Where intermediate tables go: the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    A machine-local folder serves a local master only; elsewhere executors could not read each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="slotweave-")
    return f"{shared}/{uuid.uuid4().hex}"
