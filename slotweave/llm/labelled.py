"""Bounded samples of labelled documents, and documents scored batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.llm.words import slices


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of a document's id as text, modulo ``parts``; null ids have the remainder 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts, F.lit(0)).cast("int")


def usable_labels(labels: DataFrame, label: str, parts: int, held_out: int) -> DataFrame:
    """One row (doc_id, label) per labelled document that may be learned from.

    Rows without an id or a label are left out; of a document's several rows the largest label counts.
    """
    return (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (remainder("doc_id", parts) != held_out))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )


def first_by_hash(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` rows: those with the smallest hash of the id, the same in every run."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def append_column(
    docs: DataFrame, name: str, kind: T.DataType, values: Callable[[pa.RecordBatch], pa.Array],
    keep: Callable[[pa.Array], pa.Array] | None = None, text: str = "text",
) -> DataFrame:
    """All columns and a new last one, made of whole texts slice by slice; a column of that name is replaced.

    With ``keep`` only the rows whose new value passes go on, without the new column.
    """
    kept = [c for c in docs.columns if c != name] if keep is None else docs.columns
    schema = T.StructType([docs.schema[c] for c in kept] + ([T.StructField(name, kind)] if keep is None else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            made = values(piece)
            columns = [piece.column(c) for c in kept]
            if keep is None:
                yield pa.RecordBatch.from_arrays([*columns, made], names=[*kept, name])
            else:
                yield piece.select(kept).filter(keep(made))

    return docs.select(*(f"`{c}`" for c in docs.columns)).mapInArrow(run, schema)
