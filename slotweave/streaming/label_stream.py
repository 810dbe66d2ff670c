"""Incremental labelling: new files are read, labelled and appended, each exactly once.

Labelling is stateless, so a stream needs no watermark and no state store; the checkpoint
only remembers which files are done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from slotweave.operators.labeling import label_queries
from slotweave.sources.readers import format_of
from slotweave.sources.writers import CSV_OPTIONS, JSON_OPTIONS, lists_as_text


def query_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
    max_files_per_trigger: int | None = None, **options,
) -> DataFrame:
    """A stream over the Parquet files of a folder; the schema is given, never guessed.

    For CSV and JSON use ``read_csv`` and ``read_json`` with ``stream=True``, which read as they do for tables.
    """
    reader = spark.readStream.schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(path)


def label_stream(
    stream: DataFrame, path: str, checkpoint: str, fmt: str | None = None, keep: tuple[str, ...] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True, counters: Sequence[Column] = (),
) -> StreamingQuery:
    """Append the labelled rows of ``stream`` to ``path``; start the query and return it.

    ``counters`` are aggregates of each micro-batch, to be found in its progress as ``labelling``.
    """
    name = format_of(path, fmt)
    labelled = label_queries(prepare(stream) if prepare else stream, keep)
    if counters:
        labelled = labelled.observe("labelling", *counters)
    writer = (lists_as_text(labelled) if name == "csv" else labelled).writeStream.format(name)
    writer = writer.options(**{"csv": CSV_OPTIONS, "json": JSON_OPTIONS}.get(name, {}))
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
