"""The training job: read labelled sequences, split, fit a tagger, report, save."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from slotweave.operators.chain_tagger import exists, train_chain
from slotweave.operators.metrics import classification_report, tag_pairs
from slotweave.operators.tagger import BUCKETS, Tagger, train_tagger
from slotweave.operators.training_data import train_validation_split
from slotweave.plans.scratch import scratch_path
from slotweave.sources.readers import FORMATS, add_reader_options, format_of, read_labelled, reader_options


def validation_report(tagger: Tagger, validation: DataFrame) -> DataFrame:
    """Report per tag of the tagger on labelled queries."""
    tagged = tagger.tag_tokens(validation.select("tokens", "bioes_tags"), output="predicted")
    return classification_report(tag_pairs(tagged, "bioes_tags", "predicted"))


def run(
    spark: SparkSession, source: str, model: str, fmt: str | None = None, seed: int = 0, report: str | None = None,
    max_iter: int = 30, buckets: int = BUCKETS, mode: str = "error", kind: str = "independent", passes: str | None = None,
    **options,
) -> DataFrame:
    """Fit a tagger on 80 % of the queries, save it, and write the report on the rest.

    ``kind`` is "independent", one decision per token, or "chain", the best path of each query. ``report`` (by default
    ``report`` below the model's folder) gets the report per tag as ``tags`` and the value of the objective after each
    iteration as ``objective``, both as Parquet; for a chain also the F1 of whole spans of the validation rows.
    ``passes`` is a folder for the state after each pass of a chain: given again, a run that broke off goes on where it
    was. With the mode "error", a model or report that is there is an error before anything is read. Returns the report.
    """
    report = report or f"{model}/report"
    if mode == "error":
        for path in (f"{model}/pipeline", f"{model}/vocabulary", f"{model}/chain", f"{report}/tags", f"{report}/objective"):
            if exists(spark, path):
                raise FileExistsError(f"{path} is already there")
    labelled = read_labelled(spark, source, fmt, **options)
    training, validation = train_validation_split(labelled, seed=seed)
    if kind == "chain":
        tagger = train_chain(training, passes or scratch_path(spark), validation, buckets, max_iter)
        history = spark.createDataFrame(tagger.history, "iteration int, objective double, span_f1 double")
    else:
        tagger = train_tagger(training, buckets=buckets, max_iter=max_iter)
        history = spark.createDataFrame(list(enumerate(tagger.history)), "iteration int, objective double")
    tagger.save(model, mode)
    validation_report(tagger, validation).write.mode(mode).parquet(f"{report}/tags")
    history.write.mode(mode).parquet(f"{report}/objective")
    return spark.read.parquet(f"{report}/tags")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Fit a token tagger on labelled sequences")
    parser.add_argument("--input", required=True, help="labelled sequences: CSV, JSON or Parquet path")
    parser.add_argument("--input-format", choices=FORMATS)
    add_reader_options(parser)
    parser.add_argument("--model-dir", required=True)
    parser.add_argument("--report-path", help="folder of the report; by default below the model's")
    parser.add_argument("--kind", choices=("independent", "chain"), default="independent")
    parser.add_argument("--passes-dir", help="state after each pass of a chain; given again, a run goes on where it broke off")
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--max-iter", type=int, default=30)
    parser.add_argument("--buckets", type=int, default=BUCKETS, help="hash buckets of each feature template")
    parser.add_argument("--mode", choices=("error", "overwrite"), default="error")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("train query tagger").getOrCreate()
    # JSON of labelled sequences is always lines of known fields, so of the readers' options it has none.
    csv = format_of(args.input, args.input_format) == "csv"
    options = reader_options(args, args.input, args.input_format) if csv else {}
    report = run(spark, args.input, args.model_dir, args.input_format, args.seed, args.report_path, args.max_iter,
                 args.buckets, args.mode, args.kind, args.passes_dir, **options)
    for row in report.orderBy("position", "label").collect():  # a row per tag of a closed set, and three totals
        print(row.label, row.precision, row.recall, row.f1, row.support, sep="\t")


if __name__ == "__main__":
    main()
