"""SQL functions against the column functions they come from, on odd values and on the query log."""

import pytest
from pyspark.sql import functions as F

from slotweave.operators.labeling import label_queries
from slotweave.operators.sql_functions import FUNCTIONS, register_sql_functions, sql_text
from slotweave.plans.query_log import query_log

ODD_TEXTS = (
    None, "", " ", "nan", "a,b  \"c\"", "it`s  \t´x´\n", "\\d'\\", "['a', 'b', 'a']", '["x", 1.5, 1e20, null, {}]', '{"k": "v", "k2": [1]}',
    "(p, q); r", "red|blue, green", "\x1fmark\x1f", "ünï cödé,ß", "[1e400, -1e400, NaN]", "Infinity and NaN( or(and", "x" * 5000,
)
ODD_LISTS = (
    None, [], [None], ["a", "", None, "a"], ["The", "Big", "red", "dog", "ran", "off"], ["big", "RED", "dog", "ran", "x"], ["red"],
    ["S-Brand", "B-Brand", "I-Brand", "E-Brand", "O", "S-ProductType"], ["B-Attribute", "S-Brand", "E-Attribute"], ["O"] * 300,
)


@pytest.fixture(scope="module")
def values(spark):
    register_sql_functions(spark, prefix="sw_")
    texts = [(k, text) for k, text in enumerate(ODD_TEXTS)]
    lists = [(k, items) for k, items in enumerate(ODD_LISTS)]
    made = {
        "STRING": spark.createDataFrame(texts, "k int, v string"), "ARRAY<STRING>": spark.createDataFrame(lists, "k int, v array<string>"),
        "INT": spark.createDataFrame([(k, v) for k, v in enumerate((None, -1, 0, 1, 2, 3, 50))], "k int, v int"),
    }
    made["VARIANT"] = made["STRING"].select("k", F.coalesce(F.try_parse_json("v"), F.lit("t, u").cast("variant")).alias("v"))
    return made


def _arguments(values, function):
    """Rows of arguments: every value of the first parameter beside shifted values of the others."""
    rows = None
    for place, (name, kind) in enumerate(function.parameters.items()):
        if name == "label":
            column = values["STRING"].select("k", F.get(F.array(*map(F.lit, ("Brand", "Attribute", "ProductType", "?"))), F.col("k") % 4).alias(name))
        elif kind.startswith("STRUCT"):
            column = values["ARRAY<STRING>"].select("k", FUNCTIONS["extract_entities"].body(F.col("v"), F.col("v")).alias(name))
        else:
            size = values[kind].count()
            column = values[kind].select(((F.col("k") + place * 3) % size).alias("k"), F.col("v").alias(name))
        rows = column if rows is None else rows.join(column, "k")
    return rows


@pytest.mark.parametrize("name", FUNCTIONS)
def test_equal_to_the_column_function(spark, values, name):
    function = FUNCTIONS[name]
    rows = _arguments(values, function)
    arguments = ", ".join(function.parameters)
    both = rows.select("k", F.expr(f"sw_{name}({arguments})").alias("sql"), function.body(*map(F.col, function.parameters)).alias("column"))
    found = both.collect()
    assert found and [row.sql for row in found] == [row.column for row in found]


def test_calls_of_calls_in_any_clause(spark, values):
    values["STRING"].createOrReplaceTempView("odd_texts")
    rows = spark.sql(
        "SELECT size(sw_tokenize_query(sw_clean_text(v))) AS n, count(*) AS c FROM odd_texts "
        "WHERE NOT sw_is_brand_in_query('a', v) GROUP BY 1 ORDER BY 1").collect()
    expected = [text for text in ODD_TEXTS if "a" not in (text or "").lower()]
    assert sum(row.c for row in rows) == len(expected)


def test_literals_with_marks_of_sql(spark):
    column = F.concat(F.lit("a' and(`=`('"), F.col("v"), F.lit("\\ Infinity\n\t\"NaN\""))
    rows = spark.createDataFrame([("x",)], "v string")
    assert rows.select(F.expr(sql_text(column))).first()[0] == rows.select(column).first()[0]


def test_label_query_is_the_labeller(spark, values):
    log = query_log(spark, spark.read.parquet("/root/testdata/sf0.001/part.parquet"))
    log.createOrReplaceTempView("sql_log")
    columns = ("tokens", "bioes_tags", "augmented_query", "brand_added")
    labels = spark.sql("SELECT query_id, l.* FROM (SELECT query_id, sw_label_query(query, brand, sw_parse_attributes(attributes), product_type) AS l FROM sql_log)")
    expected = label_queries(log, keep=("query_id",)).select("query_id", *columns)
    assert sorted(labels.collect()) == sorted(expected.collect())


def test_no_python_worker(spark, values):
    plan = spark.sql("SELECT sw_label_query(v, v, array(v), v) FROM VALUES ('a') AS t(v)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
