"""Sinks for labelled sequences, predictions, the leaderboard table and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.operators.decoding import leaderboard
from slotweave.sources.readers import format_of

CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
# Every field in every JSON line, also when it is NULL.
JSON_OPTIONS = {"ignoreNullFields": False}


def lists_as_text(df: DataFrame) -> DataFrame:
    """List columns as JSON text, which is a valid Python literal as well."""
    return df.select(*(
        F.to_json(field.name).alias(field.name) if isinstance(field.dataType, T.ArrayType) else F.col(f"`{field.name}`")
        for field in df.schema
    ))


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "error") -> None:
    """Write a table as CSV, JSON lines or Parquet; an unknown format is an error."""
    name = format_of(path, fmt)
    if name == "csv":
        lists_as_text(df).write.mode(mode).options(**CSV_OPTIONS).csv(path)
    elif name == "json":
        df.write.mode(mode).options(**JSON_OPTIONS).json(path)
    else:
        df.write.mode(mode).parquet(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "error") -> None:
    """Write the one row of metrics as JSON."""
    metrics.write.mode(mode).options(**JSON_OPTIONS).json(path)


def write_predictions(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write all test columns and the predicted slots as CSV."""
    write_table(df, path, "csv", mode)


def write_leaderboard(df: DataFrame, path: str, mode: str = "error", keep: tuple[str, ...] = ()) -> None:
    """Write the submission table as CSV, ``keep`` columns of ``df`` first."""
    write_table(leaderboard(df, keep), path, "csv", mode)
