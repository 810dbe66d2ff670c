import json

import pytest
from pyspark.sql import functions as F

from slotweave.operators.decoding import decode_slots
from slotweave.operators.labeling import OUTPUT_COLUMNS, label_queries
from slotweave.operators.metrics import classification_report, slot_metrics, tag_pairs
from slotweave.operators.tagger import Tagger, token_examples, train_tagger
from slotweave.operators.training_data import tag_vocabulary, train_validation_split
from slotweave.plans import evaluate_job, label_job, train_job
from slotweave.plans.queries import QUERIES
from slotweave.plans.query_log import query_log
from slotweave.plans.scratch import scratch_path
from slotweave.sources.readers import parse_list_text, read_labelled, read_queries
from slotweave.streaming.label_stream import label_stream, query_stream

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark):
    return query_log(spark, spark.read.parquet(f"{FOLDER}/part.parquet"))


def test_csv_source(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('Query,query,brand,attributes\n"a, ""q""",b,NA,"[""x"",""y\nz""]"\nonly,two\n1,2,3,4,5\n\n007,08,None,\n')
    rows = read_queries(spark, str(path)).collect()
    assert [(r["query"], r.brand, r.attributes) for r in rows] == [
        ("b", None, '["x","y\nz"]'), ("two", None, None), ("2", "3", "4"), ("08", None, None),
    ]
    assert [r.error is None for r in rows] == [True, True, False, True]
    labelled = label_queries(read_queries(spark, str(path))).collect()
    assert (labelled[2]["query"], labelled[2].tokens, labelled[2].brand_added) == ("2", [], None)
    latin = tmp_path / "latin.csv"
    latin.write_bytes("query\ncafé\n".encode("latin1"))
    assert read_queries(spark, str(latin), encoding="ISO-8859-1").first()["query"] == "café"


def test_json_sources(spark, tmp_path):
    lines, document = tmp_path / "lines.json", tmp_path / "document.json"
    lines.write_text('{"query":"red","Brand":"x","attributes":["a",1,null]}\n{"query":"b","attributes":"[\'a\']"}\n{bad\n')
    rows = label_queries(read_queries(spark, str(lines))).collect()
    assert [(r["query"], r.brand, r.attributes) for r in rows[:2]] == [("red", "x", ["a", "1"]), ("b", "", ["a"])]
    assert rows[2].error.startswith("not JSON")
    document.write_text('[\n{"query": "red",\n"brand": "x"},\n{"query": "blue"}\n]')
    assert [r["query"] for r in read_queries(spark, str(document), whole_document=True).collect()] == ["red", "blue"]


def test_input_checks(spark, tmp_path):
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    header = tmp_path / "header.csv"
    header.write_text("query,brand\n")
    for path in (empty, header):
        with pytest.raises(ValueError, match="empty"):
            read_queries(spark, str(path))
    with pytest.raises(ValueError, match="unsupported format"):
        read_queries(spark, str(tmp_path / "in.txt"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_queries(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="unsupported format"):
        label_job.run(spark, f"{FOLDER}/part.parquet", str(tmp_path / "out.xyz"))


def test_list_literals(spark):
    literals = {"['a', 'b']": ["a", "b"], """["men's", 'x']""": ["men's", "x"], "['a\\'b\"']": ["a'b\""], "['\\xad']": ["\xad"], "[]": [], '["q\\\\x41"]': ["q\\x41"]}
    df = spark.createDataFrame([(text,) for text in literals], "t string")
    assert [r[0] for r in df.select(parse_list_text(F.col("t"))).collect()] == list(literals.values())


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_label_job_round_trip(spark, log, tmp_path, fmt):
    path = str(tmp_path / f"labelled.{fmt}")
    counts = label_job.label_table(log, path)
    assert (counts["rows_read"], counts["rows_processed"], counts["errors"]) == (200, 200, 0)
    back = read_labelled(spark, path)
    assert set(OUTPUT_COLUMNS) == set(back.columns)
    key = lambda r: (r["query"], r.brand or "", tuple(r.tokens), tuple(r.bioes_tags), r.brand_added)
    assert sorted(map(key, back.collect())) == sorted(map(key, label_queries(log).collect()))


def test_evaluate_job(spark, log, tmp_path):
    test = log.select("query_id", "query", "brand", "product_type", F.array("true_attr1", "true_attr2").alias("attributes"))
    test.write.parquet(str(tmp_path / "test.parquet"))
    scores = evaluate_job.run(spark, str(tmp_path / "test.parquet"), str(tmp_path / "out")).first()
    assert scores.asDict() == slot_metrics(evaluate_job.predict_slots(test)).first().asDict()
    assert scores.brand_precision == 0.935
    written = [line for part in (tmp_path / "out" / "metrics.json").glob("part-*") for line in part.read_text().splitlines()]
    assert json.loads(written[0]) == scores.asDict()
    board = spark.read.csv(str(tmp_path / "out" / "leaderboard_submission.csv"), header=True)
    assert board.columns == ["query", "brand", "attributes_pred", "product_type", "attributes"]
    assert board.count() == 200


def test_metrics_of_no_rows(spark):
    empty = spark.createDataFrame([], "brand string, brand_pred string, product_type string, product_type_pred string, attributes array<string>, attributes_pred array<string>")
    row = slot_metrics(empty).first()
    assert row.top1_accuracy != row.top1_accuracy and row.brand_precision == 0.0 and row.attribute_recall == 0.0


def test_stream_equals_batch(spark, log, tmp_path):
    log.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = query_stream(spark, str(tmp_path / "in"), log.schema, max_files_per_trigger=2)
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = label_stream(stream, target, checkpoint, "parquet", keep=("query_id",))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 3
    columns = ["query_id", "tokens", "bioes_tags", "brand_added"]
    batch = label_queries(log, keep=("query_id",)).select(columns)
    assert sorted(batch.collect()) == sorted(spark.read.parquet(target).select(columns).collect())
    log.limit(3).write.mode("append").parquet(str(tmp_path / "in"))
    label_stream(stream, target, checkpoint, "parquet", keep=("query_id",)).awaitTermination()
    assert spark.read.parquet(target).count() == 203


def test_plans(spark, log):
    labelled = label_queries(log, keep=("query_id",))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    text = plan(labelled)
    assert "Exchange" not in text and "Python" not in text and "ArrowEval" not in text
    filtered = plan(labelled.where("query_id > 5 and size(bioes_tags) > 2 and brand_added").select("tokens"))
    assert "PushedFilters: [IsNotNull(p_partkey), GreaterThan(p_partkey,5)]" in filtered
    assert len(filtered) < 2 * len(text)


def test_tagger(spark, log, tmp_path):
    labelled = label_queries(log)
    training, validation = train_validation_split(labelled)
    assert training.count() + validation.count() == 200
    tagger = train_tagger(training, buckets=1 << 10, max_iter=10)
    tagger.save(str(tmp_path / "model"))
    loaded = Tagger.load(str(tmp_path / "model"))
    tagged = loaded.tag_tokens(labelled.select("tokens", "bioes_tags"), output="predicted").cache()
    by_rows = classification_report(tag_pairs(tagged, "bioes_tags", "predicted"))
    by_tokens = classification_report(tagger.tag_examples(token_examples(labelled, 1 << 10)), "tag", "predicted")
    assert by_rows.collect() == by_tokens.collect()
    assert by_rows.where("label = 'accuracy'").first().f1 > 0.8
    assert loaded.tag_queries(spark.createDataFrame([("",), ("red bolt",)], "query string")).collect()[0].bioes_tags == []


def _file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


CELLS = 'query,product_type,brand,attributes\nred shoe,shoe,NA,"[""red"", ""x""]"\na,b,c,d,e\nonly,two\n"x\ny",1,2,\n'
LINES = (
    '{"query": null, "Query": "alt", "attributes": [1.0, 2.50, 1e3, ["x"], 3, 0, true], "query_id": 7}\n'
    '{"query": "b", "attributes": "[\'a\']", "price": 2.50}\n{bad\n'
)


def test_csv_folder_checks_headers(spark, tmp_path):
    same = _file(tmp_path / "same", "1.csv", CELLS)
    _file(tmp_path / "same", "2.csv", "query,product_type,brand,attributes\nz,z,z,z\n")
    rows = read_queries(spark, same, "csv").collect()
    assert [r.error for r in rows if r.error] == ["more than 4 cells: a,b,c,d,e"]
    assert sorted(r["query"] for r in rows) == ["a", "only", "red shoe", "x\ny", "z"]
    other = _file(tmp_path / "other", "1.csv", "query,brand\na,b\n")
    _file(tmp_path / "other", "2.csv", "brand,query\nb,a\n")
    with pytest.raises(Exception, match="CSV header does not conform|FAILED_READ_FILE"):
        read_queries(spark, other, "csv").collect()
    twins = _file(tmp_path / "twins", "1.csv", "Query,query,QUERY,x\n1,2,3,4\n")
    assert read_queries(spark, twins, "csv").first().asDict() == {"Query.1": "1", "query": "2", "QUERY.2": "3", "x": "4", "error": None}
    _file(tmp_path / "twins", "2.csv", "Query,query,QUERY,x\n1,2,3,4\n")
    with pytest.raises(ValueError, match="column names repeat"):
        read_queries(spark, twins, "csv")


def test_json_fields_and_numbers(spark, tmp_path):
    path = _file(tmp_path / "in", "1.json", LINES)
    rows = read_queries(spark, path, "json")
    assert [(r["query"], r.query_id, r.price, (r.error or "")[:8]) for r in rows.drop("attributes").collect()] == [
        (None, "7", None, ""), ("b", None, "2.5", ""), (None, None, None, "not JSON")]
    assert label_queries(rows).first().attributes == ["1. 0", "2. 5", "1000. 0", "['x']", "3", "True"]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_streams_equal_batches(spark, tmp_path, fmt):
    text = CELLS if fmt == "csv" else LINES
    path = _file(tmp_path / "in", f"1.{fmt}", text)
    _file(tmp_path / "in", f"2.{fmt}", text.replace("red shoe", "blue shoe").replace('"b"', '"c"'))
    target = str(tmp_path / "out")
    counts = label_job.run_stream(spark, path, target, str(tmp_path / "checkpoint"), fmt, "parquet", maxFilesPerTrigger=1)
    batch = label_queries(read_queries(spark, path, fmt)).select(*OUTPUT_COLUMNS).collect()
    streamed = spark.read.parquet(target).select(*OUTPUT_COLUMNS).collect()
    assert sorted(map(str, batch)) == sorted(map(str, streamed))
    assert (counts["rows_read"], counts["errors"]) == (len(batch), 2)


def test_failed_rows_are_not_scored(spark, tmp_path):
    path = _file(tmp_path / "in", "1.csv", "query,brand,attributes,product_type\nred bolt,red,\"['bolt']\",bolt\na,b,['x','y'],c\n")
    scores = evaluate_job.run(spark, path, str(tmp_path / "out"), fmt="csv").first()
    assert scores.brand_precision == 1.0
    assert spark.read.json(str(tmp_path / "out" / "counters.json")).first().asDict() == {"rows_read": 2, "errors": 1}
    assert "error" in spark.read.csv(str(tmp_path / "out" / "predictions.csv"), header=True).columns


def test_train_job_writes_its_report(spark, log, tmp_path):
    label_job.label_table(log, str(tmp_path / "in.parquet"))
    train_job.run(spark, str(tmp_path / "in.parquet"), str(tmp_path / "model"), max_iter=3, buckets=1 << 10)
    assert spark.read.parquet(str(tmp_path / "model" / "report" / "tags")).where("label = 'accuracy'").count() == 1
    assert spark.read.parquet(str(tmp_path / "model" / "report" / "objective")).count() > 1
    with pytest.raises(Exception, match="unknown tag"):
        tag_vocabulary(spark.createDataFrame([(["S-Colour"],)], "bioes_tags array<string>")).collect()


def test_decoding_keeps_any_token(spark):
    row = ["a\x1db", None, "c\x1fd"], ["B-Brand", "I-Brand", "E-Brand"]
    df = spark.createDataFrame([row], "tokens array<string>, bioes_tags array<string>")
    assert decode_slots(df).first().brand_pred == "a\x1db  c\x1fd"


def test_queries_read_and_compute_once(spark):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    for name in ("E8_decode_ids", "F3_align_labels", "F2_vocabulary"):
        assert plan(QUERIES[name](spark, FOLDER)).count("Relation [") == 1, name
    assert "augmented_query" not in plan(QUERIES["tag_distribution"](spark, FOLDER))


def test_scratch_needs_a_shared_folder():
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_path(Cluster)
