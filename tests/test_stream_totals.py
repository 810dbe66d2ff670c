"""Counters of streams: exact beyond the progress that Spark keeps, and over restarts."""

import json

import pytest

from slotweave.plans import label_job
from slotweave.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def add_files(folder, numbers):
    folder.mkdir(exist_ok=True)
    for k in numbers:
        lines = [json.dumps({"query": f"red shoe {k}", "brand": "Nike", "attributes": "[]", "product_type": "shoe"}), json.dumps({"query": " "})]
        (folder / f"{k:03}.json").write_text("\n".join([*lines, "{not json"] if k % 3 == 0 else lines) + "\n")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_many_batches_and_restarts(spark, tmp_path, fmt):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / f"out.{fmt}"), str(tmp_path / "checkpoint")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        add_files(source, range(8))
        got = label_job.run_stream(spark, str(source), target, checkpoint, "json", maxFilesPerTrigger=1)
        assert got == {"rows_read": 19, "errors": 3, "rows_without_tokens": 8, "rows_processed": 8}
        add_files(source, range(8, 13))
        got = label_job.run_stream(spark, str(source), target, checkpoint, "json", maxFilesPerTrigger=1)
        assert got == {"rows_read": 12, "errors": 2, "rows_without_tokens": 5, "rows_processed": 5}
        # The last batch was written, but the checkpoint does not know so: it runs again and counts for nothing twice.
        last = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
        for name in (last, last.with_name(f".{last.name}.crc")):
            name.unlink(missing_ok=True)
        got = label_job.run_stream(spark, str(source), target, checkpoint, "json", maxFilesPerTrigger=1)
        assert set(got.values()) == {0}
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    files = label_job.sink_files(spark, target, fmt)
    assert label_job.written_counts(spark, files, fmt)["rows_read"] == 31


def test_registered_totals(spark):
    row = QUERIES["G1_stream_totals"](spark, FOLDER).first()
    assert row.rows_read == 400 and row.rows_without_tokens == 200
