"""The evaluation job: tag a test table, decode the slots, score them, write three results."""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.operators.columns import ERROR
from slotweave.operators.alignment import BLOCK, FILE, PLACE, aligned
from slotweave.operators.chain_tagger import load_tagger
from slotweave.operators.decoding import SLOT_COLUMNS, decode_slots
from slotweave.operators.labeling import label_queries
from slotweave.operators.metrics import slot_scores
from slotweave.operators.tagger import Tagger
from slotweave.plans.scratch import scratch_path
from slotweave.sources.readers import (
    FORMATS, add_reader_options, format_of, parse_list_text, read_in_order, read_queries, reader_options,
)
from slotweave.sources.writers import write_leaderboard, write_metrics, write_predictions

_TRUTH = ("query", "brand", "attributes", "product_type")


def _as_list(table: DataFrame, name: str) -> Column:
    """A column as ``array<string>``: list literals are read, other text counts as missing."""
    data_type = table.schema[name].dataType
    if isinstance(data_type, T.StringType):
        return parse_list_text(F.col(name))
    if isinstance(data_type, T.VariantType):
        return F.try_variant_get(name, "$", "array<string>")
    return F.col(name)


def _with_list_attributes(test: DataFrame) -> DataFrame:
    return test.withColumn("attributes", _as_list(test, "attributes"))


def predict_slots(test: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """All test columns and the predicted slots, in the same rows: there is no join.

    Without a tagger the weak labeller predicts, which is told the true slots. With one, only
    the query is used.
    """
    test = _with_list_attributes(test)
    row = test.select(F.struct("*").alias("_row"), *_TRUTH)
    if tagger is None:
        tagged = label_queries(row, keep=("_row",), outputs=("tokens", "bioes_tags"))
    else:
        tagged = tagger.tag_queries(row.select("_row", "query"))
    slots = decode_slots(tagged.select("_row", "tokens", "bioes_tags"))
    return slots.select("_row.*", *SLOT_COLUMNS)


def given_slots(spark: SparkSession, source: str, predictions: str, fmt: str | None = None, **options) -> DataFrame:
    """All test columns, and the slots of a second file with as many rows in the same order."""
    found = read_in_order(spark, predictions, **(options if format_of(predictions) == "csv" else {}))
    listed = found.withColumn("attributes_pred", _as_list(found, "attributes_pred"))
    slots = listed.select(*(F.coalesce(c, F.lit("")).alias(c) if c != "attributes_pred" else F.col(c) for c in SLOT_COLUMNS),
                          *(F.col(c) for c in (FILE, BLOCK, PLACE)))
    return _with_list_attributes(aligned(read_in_order(spark, source, fmt, **options), slots))


def run(
    spark: SparkSession, source: str, target: str, model: str | None = None, mode: str = "error",
    predictions: str | None = None, **options,
) -> DataFrame:
    """Write ``predictions.csv``, ``metrics.json`` and ``leaderboard_submission.csv`` below ``target``.

    Rows with an ``error`` stay in the predictions and the leaderboard, are not scored, and are counted in
    ``counters.json``. Returns the metrics. With ``predictions`` nothing is tagged: the slots come from that file, row by
    row, and another number of rows is an error. The tagged rows are written to the scratch folder first, so that every
    query is tagged once.
    """
    if predictions and model:
        raise ValueError("predictions are given or made by a model, not both")
    test = given_slots(spark, source, predictions, **options) if predictions else read_queries(spark, source, **options)
    if ERROR not in test.columns:
        test = test.withColumn(ERROR, F.lit(None).cast("string"))
    slots = test if predictions else predict_slots(test, load_tagger(model) if model else None)
    tagged = f"{scratch_path(spark)}/tagged"
    counters = Observation("rows")
    slots.observe(
        counters, F.count(F.lit(1)).alias("rows_read"), F.count(ERROR).alias("errors")).write.parquet(tagged)
    predictions = spark.read.parquet(tagged)
    write_predictions(predictions, f"{target}/predictions.csv", mode)
    scores = predictions.where(F.col(ERROR).isNull()).agg(*slot_scores(predictions))
    write_metrics(scores, f"{target}/metrics.json", mode)
    counts = spark.createDataFrame([counters.get], "rows_read bigint, errors bigint")
    write_metrics(counts, f"{target}/counters.json", mode)
    write_leaderboard(predictions, f"{target}/leaderboard_submission.csv", mode)
    return scores


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Score predicted query slots")
    parser.add_argument("--test-data", required=True, help="table with query, brand, attributes, product_type")
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--model-dir", help="a saved tagger; without it the weak labeller predicts")
    parser.add_argument("--predictions", help="a table of predicted slots, row by row those of the test data; nothing is tagged")
    parser.add_argument("--input-format", choices=FORMATS)
    add_reader_options(parser)
    parser.add_argument("--mode", choices=("error", "overwrite"), default="error")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("evaluate query slots").getOrCreate()
    options = reader_options(args, args.test_data, args.input_format)
    run(spark, args.test_data, args.output_dir, args.model_dir, args.mode, args.predictions, fmt=args.input_format, **options).show(vertical=True)


if __name__ == "__main__":
    main()
