"""CSV files read by ranges against Spark's reader of whole files, for every range size; headers and encodings by file."""

import csv
import io
import random

import pytest

from slotweave.plans import label_job
from slotweave.sources import readers
from slotweave.sources.csv_records import byte_ranges


@pytest.fixture
def range_bytes(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(name) for name in names]

    def to(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield to
    for name, value in zip(names, old):
        spark.conf.set(name, value)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_table(seed, n=24):
    rng = random.Random(seed)
    parts = ["a", "é", '"', '""', "\n", "\n\n", "\r\n", ",", " ", "日", "x" * 40, "'", ""]
    return [[f"{k}", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(3))] for k in range(n)]


def as_csv(rows, header, end="\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [1 << 20, 300, 61])
def test_ranges_of_any_size_give_the_same_records(spark, tmp_path, range_bytes, size, end):
    header, rows = ["query_id", "query", "brand", "note"], random_table(1)
    (tmp_path / "log.csv").write_text(as_csv(rows, header, end) + ("" if size == 61 else end * 2), newline="")
    range_bytes(size)
    assert byte_ranges(spark, str(tmp_path / "log.csv")).count() >= 1000 // size
    got = readers.read_csv(spark, str(tmp_path / "log.csv"), by_name=True)
    blank = set(readers.MISSING_TEXTS)
    want = sorted(((*(None if c in blank else c for c in row), None) for row in rows), key=str)
    assert got.columns == [*header, "error"] and rows_of(got) == want


def test_equal_to_whole_files(spark, tmp_path, range_bytes):
    text = 'query,product_type,brand,attributes\nred shoe,shoe,NA,"[""red"", ""x""]"\na,b,c,d,e\nonly,two\n\n"x\n\ny",1,2,\n"open\nto the end'
    (tmp_path / "in.csv").write_text(text)
    whole = rows_of(readers.read_csv(spark, str(tmp_path)))
    for size in (1 << 20, 20, 7):
        range_bytes(size if size != 7 else 45)
        assert rows_of(readers.read_csv(spark, str(tmp_path), by_name=True)) == whole


def test_headers_and_encodings_by_file(spark, tmp_path):
    files = {
        "a.csv": "query,brand\nq1,b1\n".encode(), "b.csv": "﻿Brand,Query,x\r\nb2,q2,é\r\n".encode(), "c.csv": "brand,query,x,x\nbé,q3,1,2\n".encode("cp1252"),
        "d.csv": b"", "e.csv": b"\n\n", "f.csv": b"query,brand\n", "g.csv": b"query,brand\nok,b\n\x81q,b\n", "h.csv": b'query,error\nq4,"it\nfailed"\nq5,,z\n',
        "i.csv": b'"que\nry",brand\nz,b\n',
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = readers.read_csv(spark, str(tmp_path), by_name=True).collect()
    got = {r["query"]: r for r in rows if r["query"]}
    assert rows[0].__fields__ == ["query", "brand", "x", "x.1", "que\nry", "error"]
    assert tuple(got["q2"])[:3] == ("q2", "b2", "é") and tuple(got["q3"])[:4] == ("q3", "bé", "1", "2") and got["q1"].x is None
    assert got["q4"].error == "it\nfailed" and got["q5"].error == "more than 2 cells: q5,,z"
    assert [r.error for r in rows if r.error and "broken" in r.error] == ["broken bytes: �q,b"] and got["ok"].error is None
    assert [r for r in rows if r["que\nry"] == "z"] and len(rows) == 8
    strict = readers.read_csv_files(spark, str(tmp_path / "c.csv"), fallback=None).collect()
    assert "broken bytes" in strict[0].error


def test_what_cannot_be_read(spark, tmp_path, range_bytes):
    (tmp_path / "a.csv").write_text("\n")
    with pytest.raises(ValueError, match="empty"):
        readers.read_csv(spark, str(tmp_path), by_name=True)
    with pytest.raises(ValueError, match="as a table"):
        readers.read_csv(spark, str(tmp_path), by_name=True, stream=True)
    (tmp_path / "b.csv").write_text('"' + "long\n" * 50 + '",brand\nx,y\n')
    range_bytes(40)
    with pytest.raises(Exception, match="header is longer|is empty"):
        readers.read_csv(spark, str(tmp_path), by_name=True).collect()


def test_the_label_job_reads_by_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Brand,Query\nNike,red shoe\n")
    (tmp_path / "in" / "b.csv").write_text('query,product_type\n"blue\nshoe",shoe\n')
    label_job.main(["-i", str(tmp_path / "in"), "-o", str(tmp_path / "out.parquet"), "--input-format", "csv", "--by-name"])
    rows = spark.read.parquet(str(tmp_path / "out.parquet")).collect()
    assert sorted(r.augmented_query for r in rows) == ["blue shoe", "red shoe Nike"]
