"""Whole JSON documents by byte ranges against Python's parser, on files cut into very small ranges."""

import json
import random

import pytest
from pyspark.sql import functions as F

from slotweave.sources.json_documents import json_records, scan
from slotweave.sources.readers import read_json

TEXTS = ("", "}", "{", "]}", '"', '\\"', "\\", "\\\\}", "é}ß", "a, b", "\n}", "[{", "x" * 90)


def _value(draw: random.Random, depth: int):
    kind = draw.randrange(7 if depth else 4)
    if kind == 0:
        return "".join(draw.choice(TEXTS) for _ in range(draw.randrange(4)))
    if kind == 1:
        return draw.randrange(1000)
    if kind in (2, 3):
        return draw.choice((None, True, False, 1.5, "t"))
    if kind == 4:
        return [_value(draw, depth - 1) for _ in range(draw.randrange(4))]
    return {draw.choice(TEXTS) + str(k): _value(draw, depth - 1) for k in range(draw.randrange(4))}


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _read(spark, path):
    rows = json_records(spark, str(path)).select(F.to_json("record").alias("record"), "_corrupt_record").collect()
    return ([json.loads(row.record) for row in rows if row.record is not None], [row._corrupt_record for row in rows if row.record is None])


def _key(value):
    return json.dumps(value, sort_keys=True)


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, small_ranges, tmp_path, seed):
    draw, expected = random.Random(seed), []
    for name in range(5):
        records = [{"n": [name, k], "v": _value(draw, 3)} for k in range(draw.choice((0, 1, 3, 40)))]
        expected += records
        text = json.dumps(records, ensure_ascii=bool(name % 2), indent=draw.choice((None, 2)))
        (tmp_path / f"{name}.json").write_bytes((draw.choice(("", "﻿", " \n")) + text + draw.choice(("", "\n", " \n\n"))).encode())
    found, broken = _read(spark, tmp_path)
    assert broken == [] and sorted(map(_key, found)) == sorted(map(_key, expected))


def test_many_ranges_are_read(spark, small_ranges, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps([{"k": k} for k in range(2000)]))
    records = json_records(spark, str(tmp_path / "1.json"))
    assert sorted(row[0] for row in records.select(F.to_json("record")).collect()) == sorted(json.dumps({"k": k}, separators=(",", ":")) for k in range(2000))
    assert records.select(F.spark_partition_id().alias("p")).distinct().count() > 50


def test_other_roots_and_items(spark, small_ranges, tmp_path):
    for name, text in enumerate((' {"a": {"b": 1}}\n', '{"a": 2}', '{"a": 3}\n{"a": 4}\n', '[5, {"a": 6}, "}", {"a": {}}, [7], 8 ]', "[]", " \n", "", "[ 9 ]")):
        (tmp_path / f"{name}.json").write_text(text)
    found, broken = _read(spark, tmp_path)
    expected = [{"a": {"b": 1}}, {"a": 2}, {"a": 3}, {"a": 4}, 5, {"a": 6}, "}", {"a": {}}, [7], 8, 9]
    assert broken == [] and sorted(map(_key, found)) == sorted(map(_key, expected))


def test_broken_items_and_files(spark, small_ranges, tmp_path):
    sound = [{"k": k, "t": "}" * (k % 5)} for k in range(50)]
    (tmp_path / "1.json").write_text(json.dumps(sound))
    (tmp_path / "2.json").write_text('[{"a": 1}, {"a": oops}, {"a": 2}, ]')
    (tmp_path / "3.json").write_text('[{"b": 1}, {"b": 2}')
    (tmp_path / "4.json").write_text('[{"c": 1} {"c": 2}, {"c": "open]')
    found, broken = _read(spark, tmp_path)
    assert sorted(map(_key, found)) == sorted(map(_key, [*sound, {"a": 1}, {"a": 2}, {"b": 1}, {"b": 2}, {"c": 1}]))
    assert sorted(text.strip().split("/")[-1] for text in broken) == sorted([', {"a": oops}'.strip(), ", ]", "3.json", "4.json", '{"c": 2}', ', {"c": "open]}'])


def test_queries_of_a_document(spark, small_ranges, tmp_path):
    records = [{"query": f"red {k}", "Brand": "x}", "attributes": ["a", {"b": k}], "price": k / 2} for k in range(30)]
    (tmp_path / "1.json").write_bytes(json.dumps(records, ensure_ascii=False).replace("red", "ré").encode("latin-1"))
    rows = read_json(spark, str(tmp_path / "1.json"), whole_document=True, encoding="ISO-8859-1").orderBy("price").drop("attributes").collect()
    assert len(rows) == 30 and {row.error for row in rows} == {None} and {row.brand for row in rows} == {"x}"}
    assert sorted(row["query"] for row in rows) == sorted(f"ré {k}" for k in range(30))


def test_escapes():
    for text in TEXTS:
        data = json.dumps({text: [text, text]}, ensure_ascii=False).encode()
        quotes, places, steps = scan(data)
        outside = (quotes.searchsorted(places) % 2) == 0
        assert len(quotes) == 6 and steps[outside].sum() == 0 and outside.sum() == 4
