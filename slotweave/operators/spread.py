"""Rows dealt evenly over the cluster, where the files of a table would make fewer tasks than there are cores.

A small file of many rows, or one of few row groups, is a handful of tasks, however costly each row is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

TASKS_PER_CORE = 4


def spread(df: DataFrame) -> DataFrame:
    """The same rows in ``TASKS_PER_CORE`` partitions a core, dealt in turn: neither equal nor null keys gather in one."""
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
