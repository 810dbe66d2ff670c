"""Files as lines in byte ranges: what the readers that split records themselves have in common."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.plans.scratch import scratch_path

#: Rows on byte ranges that are broadcast, about 100 bytes each.
MAX_RANGES = 1_000_000


def read_lines(spark: SparkSession, path: str | Sequence[str], line_break: str = "\n") -> DataFrame:
    """(file, block, line): all lines as bytes, in order within each byte range, without the ``line_break`` that ends them."""
    return spark.read.text(path, lineSep=line_break).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"))


def range_runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that lie in one byte range each."""
    if batch.num_rows == 0:
        return
    file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    number = file.indices.to_numpy()
    borders = np.flatnonzero((number[1:] != number[:-1]) | (block[1:] != block[:-1])) + 1
    for a, b in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def counted(ranges: DataFrame) -> DataFrame:
    """The table of byte ranges, computed once and written; too many for a broadcast are an error."""
    path = f"{scratch_path(ranges.sparkSession)}/ranges"
    ranges.write.parquet(path)
    written = ranges.sparkSession.read.parquet(path)
    if written.count() > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} byte ranges: raise spark.sql.files.maxPartitionBytes")
    return written


def known(value: str) -> Column:
    """A column that every line got from its byte range; a line of a range that was not counted is an error."""
    lost = F.raise_error(F.lit("a byte range was not counted: files or spark.sql.files.maxPartitionBytes have changed"))
    return F.coalesce(value, lost.cast("boolean")).alias(value)
