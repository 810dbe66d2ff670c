"""CSV files with line breaks in cells, read by many tasks each; headers and encodings may differ from file to file.

Spark reads lines by byte ranges. Whether a range begins inside a quoted cell follows from the number of quotes before it,
so a first pass counts them in each range; it also checks the bytes and keeps each file's header. In the second pass each
task joins the lines of a record. A record that goes on in the next range leaves fragments there, which alone are
shuffled. Cells are found by Spark's own CSV parser. A quote may stand only around a cell, or doubled inside one.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotweave.operators.columns import ALTERNATE_NAMES, ERROR
from slotweave.sources.byte_ranges import counted, known, range_runs, read_lines

MAX_HEADERS = 1_000
_QUOTE = b'"'
_WHOLE, _BEGIN, _MORE = range(3)  # a record, the beginning of one, a part that follows


class Header(NamedTuple):
    """A header as it is written, and the names of its columns."""

    text: str
    names: tuple[str, ...]


def numbered(cells: Sequence[str | None]) -> list[str]:
    """Names of a header's cells: blank ones are named by position, repeated ones get a number."""
    names: list[str] = []
    for position, cell in enumerate(cells):
        name = base = (cell or f"column {position}").lstrip("﻿")
        repeat = 0
        while name in names:
            repeat += 1
            name = f"{base}.{repeat}"
        names.append(name)
    return names


def canonical(names: Sequence[str]) -> tuple[str, ...]:
    """Names with an alternate name in the place of a required one that is missing turned into that."""
    renamed = {ALTERNATE_NAMES[name]: name for name in ALTERNATE_NAMES if name not in names and ALTERNATE_NAMES[name] in names}
    return tuple(renamed.get(name, name) for name in names)


def _quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, _QUOTE.decode()).to_numpy(zero_copy_only=False).astype(np.int64)


def _is_utf8(lines: pa.Array) -> bool:
    try:
        lines.cast(pa.string())
    except pa.ArrowInvalid:
        return False
    return True


def byte_ranges(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, quotes, valid, header) of each byte range: ``header`` is the first record of a file that is not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        held: list[bytes] = []

        def row(r: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([r], schema=pa.schema([
                ("file", pa.string()), ("block", pa.int64()), ("quotes", pa.int64()), ("valid", pa.bool_()), ("header", pa.binary())]))

        for batch in batches:
            for part in range_runs(batch):
                file, block, lines = part.column("file")[0].as_py(), part.column("block")[0].as_py(), part.column("line")
                if now is None or (now["file"], now["block"]) != (file, block):
                    if now:
                        yield row(now)
                    now, held = {"file": file, "block": block, "quotes": 0, "valid": True, "header": None}, []
                counts = _quotes(lines)
                if block == 0 and now["header"] is None:
                    inside = (now["quotes"] + np.cumsum(counts)) % 2
                    for line, open_ in zip(lines, inside.tolist(), strict=False):
                        if held or line.as_py().strip(b"\r\xef\xbb\xbf"):
                            held.append(line.as_py())
                            if not open_:
                                now["header"] = b"\n".join(held).removesuffix(b"\r")
                                break
                now["quotes"] += int(counts.sum())
                now["valid"] &= _is_utf8(lines)
        if now:
            yield row(now)

    return read_lines(spark, path).mapInArrow(run, "file string, block long, quotes long, valid boolean, header binary")


def _joined(lines: pa.Array, begins: np.ndarray) -> pa.Array:
    """Lines from each marked one up to the next in one piece."""
    offsets = np.append(np.flatnonzero(begins), len(lines)).astype(np.int32)
    if len(offsets) == len(lines) + 1:
        return lines
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), b"\n")


def _decoded(pieces: pa.Array, charset: str | None) -> pa.Array:
    """Text of whole records; ``charset`` None stands for UTF-8 that has been checked."""
    if charset is None:
        return pieces.cast(pa.string())
    return pa.array([p.as_py().decode(charset, "replace") for p in pieces], pa.string())


def _pieces(lines: DataFrame) -> DataFrame:
    """(file, block, first, kind, piece) of lines with ``inside``, whether their range begins within a cell.

    ``first`` marks the record that a file begins with, blank lines aside: its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, held, inside, kind, headed = None, [], False, _WHOLE, False
        names = ["file", "block", "first", "kind", "piece"]

        def out(pieces: pa.Array, kinds: np.ndarray) -> pa.RecordBatch:
            nonlocal headed
            file, block = where
            first = np.zeros(len(pieces), bool)
            if block == 0 and not headed:
                filled = [k for k, p in enumerate(pieces) if p.as_py().strip(b"\r\xef\xbb\xbf")][:1]
                first[filled], headed = True, bool(filled)
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * len(pieces)), pa.array([block] * len(pieces), pa.int64()), pa.array(first),
                 pa.array(kinds, pa.int32()), pieces], names=names)

        def rest() -> Iterator[pa.RecordBatch]:
            """What is held at a range's end goes on in the next range."""
            if held:
                yield out(pa.array([b"\n".join(held)], pa.binary()), np.array([_MORE if kind == _MORE else _BEGIN]))

        for batch in batches:
            for part in range_runs(batch):
                place = part.column("file")[0].as_py(), part.column("block")[0].as_py()
                if place != where:
                    yield from rest()
                    where, held, headed = place, [], False
                    inside = bool(part.column("inside")[0].as_py())
                    kind = _MORE if inside else _WHOLE
                lines = part.column("line")
                open_after = (int(inside) + np.cumsum(_quotes(lines))) % 2 == 1
                begins = ~np.append(inside, open_after[:-1])
                closed = np.flatnonzero(~open_after)
                if not len(closed):
                    held += lines.to_pylist()
                else:
                    end = int(closed[-1]) + 1
                    marks = begins[:end].copy()
                    marks[0] = True
                    pieces = _joined(lines.slice(0, end), marks)
                    kinds = np.full(len(pieces), _WHOLE)
                    if held or kind == _MORE:
                        head = pa.array([b"\n".join([*held, pieces[0].as_py()])], pa.binary())
                        pieces = pa.concat_arrays([head, pieces.slice(1).cast(pa.binary())])
                        kinds[0] = kind
                    yield out(pieces.cast(pa.binary()), kinds)
                    held, kind = lines.slice(end).to_pylist(), _WHOLE
                inside = bool(open_after[-1])
        if where:
            yield from rest()

    return lines.mapInArrow(run, "file string, block long, first boolean, kind int, piece binary")


def _as_texts(pieces: DataFrame, ranges: DataFrame, fallback: str | None) -> DataFrame:
    """(file, record, broken) of whole records; ``broken`` marks bytes that the file's encoding does not have."""
    charsets = F.broadcast(ranges.groupBy("file").agg(F.every("valid").alias("valid")))
    checked = pieces.join(charsets, "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid = batch.column("valid").to_numpy(zero_copy_only=False)
            for is_valid in (True, False):
                rows = batch.filter(pa.array(valid == is_valid))
                if rows.num_rows:
                    texts = _decoded(rows.column("piece"), None if is_valid else fallback or "utf-8")
                    broken = pa.array(np.zeros(len(texts), bool)) if is_valid else pc.match_substring(texts, "�")
                    yield pa.RecordBatch.from_arrays([rows.column("file"), texts, broken], names=["file", "record", "broken"])

    texts = checked.select("file", "piece", "valid").mapInArrow(run, "file string, record string, broken boolean")
    record = F.regexp_replace("record", r"\r\z", "")
    return texts.select("file", record.alias("record"), "broken").where(F.length("record") > 0)


def csv_records(spark: SparkSession, path: str | Sequence[str], fallback: str | None = "cp1252") -> tuple[DataFrame, DataFrame]:
    """(file, record, broken) of all records but the headers, and (file, header) of all files that are not blank.

    A file whose bytes are not UTF-8 is read as ``fallback``, a charset in which line breaks and quotes are those of ASCII.
    """
    ranges = counted(byte_ranges(spark, path))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = ranges.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    lines = read_lines(spark, path).join(F.broadcast(begun), ["file", "block"], "left")
    pieces = _pieces(lines.select("file", "block", known("inside"), "line"))
    whole = pieces.where((F.col("kind") == _WHOLE) & ~F.col("first")).select("file", "piece")
    # Only pieces of records that cross a border are grouped: at most two for each range.
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == _BEGIN)
    parts = pieces.where(F.col("kind") != _WHOLE).withColumn("record", F.sum((F.col("kind") == _BEGIN).cast("int")).over(order))
    crossing = parts.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("parts"), F.max("first").alias("first")).where(~F.col("first"))
    joined = crossing.select("file", _concat_binary(F.transform("parts", lambda p: p["piece"])).alias("piece"))
    headers = ranges.where(F.col("header").isNotNull())
    return _as_texts(whole.union(joined), ranges, fallback), _as_texts(
        headers.select("file", F.col("header").alias("piece")), ranges, fallback).select("file", F.col("record").alias("header"))


def _concat_binary(pieces: Column) -> Column:
    """Binary pieces with line breaks between them."""
    first, rest = F.get(pieces, F.lit(0)), F.slice(pieces, F.lit(2), F.size(pieces))
    return F.aggregate(rest, first, lambda done, piece: F.concat(done, F.lit(b"\n"), piece))


def header_catalogue(headers: DataFrame) -> list[Header]:
    """The different headers, in the order of the first file with each; more than ``MAX_HEADERS`` are an error."""
    rows = headers.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").limit(MAX_HEADERS + 1).collect()
    if len(rows) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers")
    catalogue = []
    for row in rows:
        cells = next(csv.reader(io.StringIO(row["header"].lstrip("﻿"), newline=""), strict=False), [])
        catalogue.append(Header(row["header"], canonical(numbered(cells))))
    return catalogue


def cells_by_name(records: DataFrame, headers: DataFrame, names_of: list[Header], dialect: dict) -> tuple[DataFrame, list[str]]:
    """(cells, error) with one text of ``cells`` for each name of any header, NULL where a file lacks it; and the names.

    A record with more cells than its file's header, or with broken bytes, gets an ``error`` that ends in the record.
    """
    names = list(dict.fromkeys(name for header in names_of for name in header.names))
    width = max(len(header.names) for header in names_of) + 1
    schema = ", ".join(f"_{k} string" for k in range(width))
    numbers = F.create_map(*(F.lit(x) for k, header in enumerate(names_of) for x in (header.text, k)))
    of_file = headers.select("file", F.element_at(numbers, F.col("header")).alias("number"))
    lost = F.raise_error(F.concat(F.lit("the header is longer than a byte range: "), F.col("file")))
    parsed = records.join(F.broadcast(of_file), "file", "left").select(
        F.coalesce("number", lost.cast("int")).alias("number"), "record", "broken", F.from_csv("record", schema, {**dialect, "multiLine": "true"}).alias("c"))
    listed = parsed.select("number", "record", "broken", F.array(*(f"c._{k}" for k in range(width))).alias("c"))
    places = F.array(*(F.array(*(F.lit(header.names.index(name) if name in header.names else None).cast("int") for name in names))
                       for header in names_of))
    sizes = F.array(*(F.lit(len(header.names)) for header in names_of))
    size = F.get(sizes, F.col("number"))
    error = F.when(F.col("broken"), F.concat(F.lit("broken bytes: "), F.col("record"))).when(
        F.get("c", size).isNotNull(), F.concat(F.lit("more than "), size.cast("string"), F.lit(" cells: "), F.col("record")))
    cells = F.transform(F.get(places, F.col("number")), lambda place: F.get("c", place))
    return listed.select(cells.alias("cells"), error.alias(ERROR)), names
