"""Rows of two tables by their place in the files."""

import pytest
from pyspark.sql import functions as F

from slotweave.operators.alignment import aligned, numbered
from slotweave.plans import evaluate_job
from slotweave.sources.readers import read_in_order


def test_numbers_follow_files_and_lines(spark, tmp_path):
    sizes = (1 << 20, 60)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(name) for name in names]
    (tmp_path / "in").mkdir()
    at = 0
    for k, n in enumerate((3, 0, 40, 1)):
        (tmp_path / "in" / f"{k}.csv").write_text("a,b\n" + "".join(f"row {at + i},{'x' * (i % 7)}\n" for i in range(n)))
        at += n
    try:
        for size in sizes:
            for name in names:
                spark.conf.set(name, str(size))
            rows = numbered(read_in_order(spark, str(tmp_path / "in"), "csv", multi_line=False)).collect()
            assert sorted((r.row_number, r.a) for r in rows) == [(k, f"row {k}") for k in range(44)]
    finally:
        for name, value in zip(names, old):
            spark.conf.set(name, value)


def test_truth_and_predictions_in_two_files(spark, tmp_path):
    (tmp_path / "test.csv").write_text("query,brand,attributes,product_type\nq1,A,\"['x']\",t\nq2,B,[],t\nq3,C,[],u,surplus\n")
    (tmp_path / "found.csv").write_text("product_type_pred,brand_pred,attributes_pred\nt,A,\"['x']\"\n,B,[]\nu,C,[]\n")
    scores = evaluate_job.run(spark, str(tmp_path / "test.csv"), str(tmp_path / "out"), predictions=str(tmp_path / "found.csv")).first()
    assert (scores.top1_accuracy, scores.brand_precision, scores.product_type_recall, scores.attribute_recall) == (0.5, 1.0, 0.5, 1.0)
    assert spark.read.json(str(tmp_path / "out" / "counters.json")).first().asDict() == {"rows_read": 3, "errors": 1}
    with (tmp_path / "found.csv").open("a") as file:
        file.write("u,C,[]\n")
    with pytest.raises(ValueError, match="3 rows cannot be aligned with 4"):
        evaluate_job.run(spark, str(tmp_path / "test.csv"), str(tmp_path / "more"), predictions=str(tmp_path / "found.csv"))
    with pytest.raises(ValueError, match="not both"):
        evaluate_job.run(spark, str(tmp_path / "test.csv"), str(tmp_path / "more"), "model", predictions=str(tmp_path / "found.csv"))


def test_columns_of_the_same_name(spark, tmp_path):
    spark.range(5).select(F.col("id").alias("k"), F.lit("old").alias("v")).coalesce(1).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(5).select((F.col("id") * 10).alias("v")).coalesce(1).write.parquet(str(tmp_path / "b.parquet"))
    both = aligned(*(read_in_order(spark, str(tmp_path / f"{n}.parquet")) for n in "ab"))
    assert sorted(tuple(r) for r in both.collect()) == [(k, 10 * k) for k in range(5)]
    empty = aligned(*(read_in_order(spark, str(tmp_path / f"{n}.parquet")).where("v = 'none'") for n in "aa"))
    assert empty.collect() == []
