"""Costly steps on tables that come as one file: every core has a part of the rows."""

import pytest

from slotweave.operators.spread import spread
from slotweave.plans import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    parts = [(k, f"red shoe {k}", "small steel", "Brand#11") for k in range(400)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_brand string").coalesce(1).write.parquet(f"{path}/part.parquet")
    texts = [(k, " ".join(f"w{k % 7}{j}" for j in range(20)), "web") for k in range(400)]
    spark.createDataFrame(texts, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return path


def rows_by_task(df):
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


def test_equal_and_null_rows_are_dealt_evenly(spark):
    sizes = rows_by_task(spread(spark.createDataFrame([(None,)] * 640, "query string").coalesce(1)))
    assert len(sizes) >= 8 and sum(sizes) == 640 and max(sizes) <= 2 * 640 / len(sizes)


@pytest.mark.parametrize("name", ["F3_align_labels", "F3_subword_inputs", "C6_label_documents"])
def test_documents_of_one_file(spark, folder, name):
    sizes = rows_by_task(queries.QUERIES[name](spark, folder))
    assert sum(sizes) == 400 and max(sizes) <= 100


def test_sides_of_one_file(spark, folder):
    training, validation = queries._sides(spark, folder)
    assert training.count() + validation.count() == 400
    assert len(training.inputFiles()) >= 8


def test_stream_batches(spark, folder, monkeypatch):
    """A batch takes a file for each core, and blank rows lie in all files."""
    seen, run_stream = [], queries.run_stream

    def watched(spark, source, *arguments, **options):
        blank = spark.read.parquet(source).where("query = ' '").selectExpr("_metadata.file_path as file").groupBy("file").count().collect()
        seen.append((options["maxFilesPerTrigger"], max(row["count"] for row in blank)))
        return run_stream(spark, source, *arguments, **options)

    monkeypatch.setattr(queries, "run_stream", watched)
    assert queries.stream_totals(spark, folder).first().asDict() == {
        "rows_read": 800, "errors": 0, "rows_without_tokens": 400, "rows_processed": 400}
    assert len(seen) == 2 and all(files >= 8 and most <= 50 for files, most in seen)
