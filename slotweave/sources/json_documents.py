"""Whole JSON documents, lists of records, read by many tasks each.

Spark reads a file as pieces that end in ``}``, by byte ranges. Where a record ends follows from two running values: whether a text
is open, which is the parity of the quotes before, and how many brackets are open. Both compose over byte ranges: a first pass
counts, for each range, its quotes and its brackets under either beginning; sums over the ranges of a file give each range's true
beginning. In the second pass each task cuts its range after the ``}`` that end a record. Only the parts of records that cross a
border are shuffled. Records are parsed by Spark's JSON parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotweave.sources.byte_ranges import counted, known, range_runs, read_lines

_QUOTE, _BACKSLASH, _OPENS, _CLOSES = b'"'[0], b"\\"[0], b"{"[0], b"}"[0]
_CASE = _OPENS ^ b"["[0]  # the bit in which a brace differs from a bracket
_BLANKS = b" \t\r\n\xef\xbb\xbf"
_BLANK_START = r"^\ufeff?\s*"
_WHOLE, _BEGIN, _MORE = range(3)  # a record, the beginning of one, a part that follows
# Charsets in which the byte of a brace, a quote or a backslash is never part of another character.
_PLAIN_CHARSET = re.compile(r"utf-?8|(us-?)?ascii|iso-?8859-\d+|latin-?\d|(windows-|cp)125\d", re.IGNORECASE)


def is_plain(encoding: str) -> bool:
    """Whether files of this encoding can be cut by bytes."""
    return _PLAIN_CHARSET.fullmatch(encoding) is not None


def _bytes(pieces: pa.Array) -> bytes:
    """The pieces with the brace after each."""
    return b"}".join([*pieces.to_pylist(), b""])


def scan(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the quotes that open or close a text, of all braces and brackets, and 1 or -1 for each of the latter."""
    codes = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(codes == _QUOTE)
    slashes = np.flatnonzero(codes == _BACKSLASH)
    if len(slashes) and len(quotes):
        fresh = np.append(True, np.diff(slashes) != 1)
        run = np.arange(len(slashes)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1] + 1
        at = np.searchsorted(slashes, quotes - 1)
        here = np.minimum(at, len(slashes) - 1)
        escaped = (slashes[here] == quotes - 1) & (run[here] % 2 == 1)
        quotes = quotes[~escaped]
    folded = codes | _CASE
    places = np.flatnonzero((folded == _OPENS) | (folded == _CLOSES))
    return quotes, places, np.where(folded[places] == _OPENS, 1, -1)


def byte_ranges(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, quotes, outside, within, root) of each byte range.

    ``outside`` and ``within`` are the changes of the depth if the range begins outside or within a text, ``root`` is its
    first character that is not blank. The brace after a file's last piece is counted, there or not.
    """
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("quotes", pa.int64()), ("outside", pa.int64()),
                        ("within", pa.int64()), ("root", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        for batch in batches:
            for part in range_runs(batch):
                place = {"file": part.column("file")[0].as_py(), "block": part.column("block")[0].as_py()}
                if now is None or (now["file"], now["block"]) != (place["file"], place["block"]):
                    if now:
                        yield pa.RecordBatch.from_pylist([now], schema=schema)
                    now = {**place, "quotes": 0, "outside": 0, "within": 0, "root": None}
                data = _bytes(part.column("line"))
                quotes, places, steps = scan(data)
                odd = (np.searchsorted(quotes, places) + now["quotes"]) % 2 == 1
                now["outside"] += int(steps[~odd].sum())
                now["within"] += int(steps[odd].sum())
                now["quotes"] += len(quotes)
                now["root"] = now["root"] or data[:-1].lstrip(_BLANKS)[:1].decode("latin-1") or None
        if now:
            yield pa.RecordBatch.from_pylist([now], schema=schema)

    return read_lines(spark, path, "}").mapInArrow(
        run, "file string, block long, quotes long, outside long, within long, root string")


def _beginnings(ranges: DataFrame) -> DataFrame:
    """What a range's task has to know: how it begins, how deep a record's end lies, and how the file ends.

    The depth at the end of a sound file is 0, or -1 with a brace too many; any other makes it ``broken``.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    inside = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")
    stepped = ranges.select("*", inside).select("*", F.when(F.col("inside"), F.col("within")).otherwise(F.col("outside")).alias("step"))
    known_ends = stepped.select(
        "file", "block", "inside", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("depth"),
        F.min_by("root", F.when(F.col("root").isNotNull(), F.col("block"))).over(whole).alias("root"),
        F.sum("step").over(whole).alias("end"), (F.sum("quotes").over(whole) % 2 == 1).alias("open"),
        (F.col("block") == F.min("block").over(whole)).alias("first"), (F.col("block") == F.max("block").over(whole)).alias("last"))
    level = F.when(F.col("root") == "[", 1).otherwise(0)
    return known_ends.select(
        "file", "block", "inside", "depth", "root", "first", "last", level.alias("level"),
        (F.col("first") | (~F.col("inside") & (F.col("depth") == level))).alias("begun"),
        (F.col("end") < 0).alias("surplus"), (F.col("open") | ~F.col("end").isin(0, -1)).alias("broken"))


def _segments(lines: DataFrame, charset: str) -> DataFrame:
    """(file, block, root, broken, first, tail, kind, text): pieces put together up to the ends of records.

    ``first`` marks what a file begins with, ``tail`` what follows its last record.
    """
    names = ["file", "block", "root", "broken", "first", "tail", "kind", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        held, inside, depth, kind, first = [], False, 0, _WHOLE, False

        def out(texts: list[bytes], kinds: list[int], tail: bool = False) -> pa.RecordBatch:
            nonlocal first
            n = len(texts)
            flags = [first, *[False] * (n - 1)]
            first = False
            return pa.RecordBatch.from_arrays([
                pa.array([now["file"]] * n, pa.string()), pa.array([now["block"]] * n, pa.int64()), pa.array([now["root"]] * n, pa.string()),
                pa.array([now["broken"]] * n, pa.bool_()), pa.array(flags, pa.bool_()), pa.array([tail] * n, pa.bool_()),
                pa.array(kinds, pa.int32()), pa.array([text.decode(charset, "replace") for text in texts], pa.string())], names=names)

        def rest() -> Iterator[pa.RecordBatch]:
            """What is left at a range's end goes on in the next range, or ends the file."""
            text = b"".join(held)
            if now["last"]:
                text = text[:-1] if now["surplus"] else text
            if text:
                yield out([text], [kind if now["last"] or kind == _MORE else _BEGIN], now["last"])

        for batch in batches:
            for part in range_runs(batch):
                place = part.column("file")[0].as_py(), part.column("block")[0].as_py()
                if now is None or (now["file"], now["block"]) != place:
                    if now:
                        yield from rest()
                    now = {name: part.column(name)[0].as_py() for name in part.schema.names if name != "line"}
                    held, inside, depth, first = [], now["inside"], now["depth"], now["first"]
                    kind = _WHOLE if now["begun"] else _MORE
                data = _bytes(part.column("line"))
                quotes, places, steps = scan(data)
                outside = (np.searchsorted(quotes, places) + int(inside)) % 2 == 0
                depths = depth + np.cumsum(steps * outside)
                sizes = pc.binary_length(part.column("line")).to_numpy(zero_copy_only=False)
                ends = np.searchsorted(places, np.cumsum(sizes.astype(np.int64) + 1) - 1)
                cuts = (places[ends[outside[ends] & (depths[ends] == now["level"])]] + 1).tolist()
                texts = [data[a:b] for a, b in zip([0, *cuts], cuts)]
                if texts:
                    texts[0] = b"".join([*held, texts[0]])
                    yield out(texts, [kind, *[_WHOLE] * (len(texts) - 1)])
                    held, kind = [], _WHOLE
                held.append(data[cuts[-1] if cuts else 0:])
                inside, depth = (int(inside) + len(quotes)) % 2 == 1, int(depths[-1])
        if now:
            yield from rest()

    return lines.mapInArrow(
        run, "file string, block long, root string, broken boolean, first boolean, tail boolean, kind int, text string")


def _joined(segments: DataFrame) -> DataFrame:
    """Segments with the parts of records that cross borders put together; those of broken files stay apart."""
    columns = ["file", "root", "first", "tail", "text"]
    is_part = (F.col("kind") != _WHOLE) & ~F.col("broken")
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == _BEGIN)
    parts = segments.where(is_part).withColumn("record", F.sum((F.col("kind") == _BEGIN).cast("int")).over(order))
    crossing = parts.groupBy("file", "root", "record").agg(
        F.max("first").alias("first"), F.max("tail").alias("tail"),
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    joined = crossing.withColumn("text", F.array_join(F.transform("parts", lambda part: part["text"]), ""))
    return segments.where(~is_part).select(*columns).union(joined.select(*columns))


def json_records(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """(record variant, _corrupt_record string) of all files, each a list of records or records one after the other.

    An item that is no JSON gives a row with its text as ``_corrupt_record`` and leaves the others alone. A file whose brackets
    or quotes do not close gives one more such row, which names it, and its records across borders of ranges as parts; its last part may show a closing brace too many.
    A file of blanks and an empty list give no row. A list without any object in it is one item to a task.
    """
    begun = _beginnings(counted(byte_ranges(spark, path)))
    lines = read_lines(spark, path, "}").join(F.broadcast(begun), ["file", "block"], "left")
    names = ("inside", "depth", "root", "first", "last", "level", "begun", "surplus", "broken")
    segments = _segments(lines.select("file", "block", known("inside"), *names[1:], "line"), encoding)
    text, first, tail = F.col("text"), F.col("first"), F.col("tail")

    def without(texts: Column, pattern: str) -> Column:
        """The texts without what the pattern finds; NULL where it finds nothing."""
        return F.when(F.rlike(texts, F.lit(pattern)), F.regexp_replace(texts, pattern, ""))

    listed = F.col("root") == "["
    empty_list = tail & F.when(first, F.rlike(text, F.lit(rf"{_BLANK_START}\[\s*\]\s*$"))).otherwise(F.rlike(text, F.lit(r"^\s*\]\s*$")))
    nothing = F.rlike(text, F.lit(rf"{_BLANK_START}$")) | (listed & empty_list)
    opened = F.when(first, without(text, rf"{_BLANK_START}\[")).otherwise(without(text, r"^\s*,"))
    closed = F.when(tail, without(opened, r"\]\s*$")).otherwise(opened)
    items = F.when(listed, closed).otherwise(F.regexp_replace(text, _BLANK_START, ""))
    filled = F.when(F.length(F.trim(items)) > 0, F.concat(F.lit("["), items, F.lit("]")))
    parsed = _joined(segments).where(~nothing).select(text, F.from_json(filled, "array<variant>").alias("items"))
    rows = parsed.select(
        F.explode_outer("items").alias("record"), F.when(F.col("items").isNull(), text).alias("_corrupt_record"))
    unclosed = begun.where("first AND broken").select(
        F.lit(None).cast("variant").alias("record"),
        F.concat(F.lit("brackets or quotes do not close in "), F.col("file")).alias("_corrupt_record"))
    return rows.union(unclosed)
