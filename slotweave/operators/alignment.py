"""Rows of two tables put side by side by their place in the files, where no key tells which belong together.

Rows are numbered in the order of files and of lines in them. Each task numbers its own byte range; how many rows the
ranges before it hold is a sum over one row per range. Numbers meet in an equi-join, so no table passes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE, BLOCK, PLACE = "_file", "_block", "_place"


def position_columns() -> list[Column]:
    """File, byte range and place of each row; to be selected right from a file source."""
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(PLACE)]


def _ranges(df: DataFrame) -> DataFrame:
    """(file, range, first place, rows before) of each byte range that holds rows."""
    counted = df.groupBy(FILE, BLOCK).agg(F.min(PLACE).alias("first"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(FILE, BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    return counted.select(FILE, BLOCK, "first", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))


def numbered(df: DataFrame, number: str = "row_number") -> DataFrame:
    """Rows with ``position_columns`` get their number from 0 in file order in the place of those."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in (FILE, BLOCK, PLACE)]
    return df.join(F.broadcast(_ranges(df)), [FILE, BLOCK]).select(
        *others, (F.col("before") + F.col(PLACE) - F.col("first")).alias(number))


def aligned(left: DataFrame, right: DataFrame, number: str = "row_number") -> DataFrame:
    """All columns of both tables, row by row; tables of different lengths are an error.

    Both come with ``position_columns``; columns of ``right`` take the place of those of ``left`` with the same name.
    """
    sizes = [df.count() for df in (left, right)]
    if sizes[0] != sizes[1]:
        raise ValueError(f"{sizes[0]} rows cannot be aligned with {sizes[1]}")
    one, two = numbered(left, number), numbered(right, number)
    kept = [F.col(f"`{c}`") for c in one.columns if c not in two.columns]
    return one.select(number, *kept).join(two, number).drop(number)
