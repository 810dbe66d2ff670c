"""The batch labelling job: read, label, write, count."""

from __future__ import annotations

import argparse
import time
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotweave.operators.chain_tagger import exists
from slotweave.operators.columns import ERROR
from slotweave.operators.labeling import label_queries
from slotweave.sources.readers import (
    add_reader_options, format_of, read_csv, read_json, read_labelled, read_queries, reader_options,
)
from slotweave.sources.writers import write_table
from slotweave.streaming.label_stream import label_stream, query_stream


def job_counters() -> list[Column]:
    """Counts of a labelling run: all rows, failed rows, rows without tokens, labelled rows."""
    failed = F.col(ERROR).isNotNull()
    empty = ~failed & (F.size("tokens") == 0)
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(failed).alias("errors"),
        F.count_if(empty).alias("rows_without_tokens"),
        F.count_if(~failed & ~empty).alias("rows_processed"),
    ]


def label_table(
    df: DataFrame, path: str, fmt: str | None = None, mode: str = "error", keep: tuple[str, ...] = ()
) -> dict:
    """Label ``df`` and write it to ``path``, ``keep`` columns first; the counters come from the same pass."""
    name = format_of(path, fmt)
    counters, start = Observation("labelling"), time.monotonic()
    write_table(label_queries(df, keep).observe(counters, *job_counters()), path, name, mode)
    elapsed = time.monotonic() - start
    counts = counters.get
    return {**counts, "elapsed_sec": elapsed, "rows_per_sec": counts["rows_processed"] / elapsed}


def run(
    spark: SparkSession, source: str, target: str, source_format: str | None = None,
    target_format: str | None = None, mode: str = "error", partitions: int | None = None,
    keep: tuple[str, ...] = (), **options,
) -> dict:
    """Label the table at ``source`` into ``target`` and return the counters.

    ``partitions`` spreads an input that Spark cannot split, such as one multi-line CSV file.
    """
    format_of(target, target_format)
    df = read_queries(spark, source, source_format, **options)
    if partitions:
        df = df.repartition(partitions)
    return label_table(df, target, target_format, mode, keep)


def sink_files(spark: SparkSession, path: str, fmt: str) -> set[str]:
    """Files of a stream's sink that are committed; none before the first run."""
    if not exists(spark, path):
        return set()
    return set(spark.read.schema("error string").format(fmt).load(path).inputFiles())


def written_counts(spark: SparkSession, files: set[str], fmt: str) -> dict[str, int]:
    """The counters of labelled rows, read back from the files that hold them."""
    paths = sorted(files)
    if not paths:
        return spark.createDataFrame([], "tokens array<string>, error string").agg(*job_counters()).first().asDict()
    rows = spark.read.parquet(*paths) if fmt == "parquet" else read_labelled(spark, paths, fmt)
    return rows.agg(*job_counters()).first().asDict()


def run_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, source_format: str | None = None,
    target_format: str | None = None, keep: tuple[str, ...] = (), **options,
) -> dict:
    """Label the files at ``source`` that the checkpoint does not know yet, append them, and return their counters.

    The counters are those of the rows in the files that this run committed, read back from the sink: exact for any
    number of micro-batches, and for one that an earlier run left unfinished or the sink had already.
    """
    fmt, target_fmt = format_of(source, source_format), format_of(target, target_format)
    if fmt == "parquet":
        rows = query_stream(spark, source, spark.read.parquet(source).schema, **options)
    else:
        reader = read_csv if fmt == "csv" else partial(read_json, further=keep)
        rows = reader(spark, source, stream=True, **options)
    before = sink_files(spark, target, target_fmt)
    label_stream(rows, target, checkpoint, target_fmt, keep).awaitTermination()
    return written_counts(spark, sink_files(spark, target, target_fmt) - before, target_fmt)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Label a table of search queries with BIOES tags")
    parser.add_argument("--input", "-i", required=True, help="CSV, JSON or Parquet path")
    parser.add_argument("--output", "-o", required=True, help="CSV, JSON or Parquet path")
    parser.add_argument("--input-format", choices=("csv", "json", "parquet"))
    parser.add_argument("--output-format", choices=("csv", "json", "parquet"))
    parser.add_argument("--mode", choices=("error", "overwrite", "append"), default="error")
    parser.add_argument("--keep", nargs="*", default=(), help="further input columns to carry along")
    parser.add_argument("--checkpoint", help="label new files only, as a stream with this checkpoint folder")
    add_reader_options(parser)
    parser.add_argument("--partitions", type=int, help="spread the input over this many tasks")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("label queries").getOrCreate()
    options, keep = reader_options(args, args.input, args.input_format), tuple(args.keep)
    if args.checkpoint:
        counts = run_stream(spark, args.input, args.output, args.checkpoint, args.input_format, args.output_format, keep, **options)
    else:
        counts = run(spark, args.input, args.output, args.input_format, args.output_format, args.mode,
                     args.partitions, keep, **options)
    for name, value in counts.items():
        print(f"{name}: {value}")


if __name__ == "__main__":
    main()
