"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; print one JSON line.

The tables there are one row group each, which is one task whatever the machine. As a table of many files would, their
rows are first dealt to ``FILES`` files each; that is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from slotweave.operators.labeling import label_queries  # noqa: E402
from slotweave.plans.queries import QUERIES  # noqa: E402
from slotweave.plans.query_log import query_log  # noqa: E402

HEADLINES = (
    "tag_distribution", "B1_clean_documents", "B2_tokenize_conversations", "B3_parse_attribute_mix",
    "B3b_parse_event_objects", "B3d_parse_loose_documents", "C6_label_query_log", "C6_label_documents",
    "D1_decode_entities", "E5_metric_pack",
)
RUNS = 2
#: The throughput figure: the part table this many times over with distinct keys, every row labelled and used.
COPIES = 50
FILES = 16
TABLES = ("part", "documents", "conversations", "events")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    source, folder = folder, tempfile.mkdtemp(prefix="bench-")
    for name in TABLES:
        spark.read.parquet(f"{source}/{name}.parquet").repartition(FILES).write.parquet(f"{folder}/{name}.parquet")
    seconds, building = {}, {}
    for name in HEADLINES:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            df = QUERIES[name](spark, folder)
            built = time.perf_counter() - start
            df.write.format("noop").mode("overwrite").save()
            best = min(best or (1e9, 0), (time.perf_counter() - start, built))
        seconds[name], building[name] = (round(x, 3) for x in best)
    part = spark.read.parquet(f"{folder}/part.parquet")
    rows = part.count() * COPIES
    copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy")
    many = part.select("*", copy).withColumn("p_partkey", F.col("p_partkey") * COPIES + F.col("copy")).drop("copy")
    labelled = label_queries(query_log(spark, many.repartition(4 * int(cpus))), keep=("query_id",))
    start = time.perf_counter()
    labelled.write.format("noop").mode("overwrite").save()
    labelling = time.perf_counter() - start
    print(json.dumps({
        "metric": "total of the headline queries, best of 2", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(source.rstrip("/")).removeprefix("sf"),
        "plan_building_sec": building, "labelled_rows": rows, "labelled_rows_per_sec": round(rows / labelling),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
