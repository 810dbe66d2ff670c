"""Intermediate tables in the folder that all executors and the driver share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Where that is unset, a local master takes the warehouse; on a cluster that is an error, as nothing says that the
    executors share a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """Write a table and read it again, so that a lost executor costs no more than the tasks it ran."""
    spark = rows.sparkSession
    path = shared_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
