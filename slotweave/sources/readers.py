"""Query tables and labelled sequences from CSV, JSON and Parquet.

Everything is read as text; no types are guessed. Rows that cannot be read are kept, with the
reason in ``error``.
"""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from slotweave.functions.attributes import number_text
from slotweave.operators.alignment import position_columns
from slotweave.operators.columns import ALTERNATE_NAMES, ERROR
from slotweave.sources.csv_records import cells_by_name, csv_records, header_catalogue, numbered
from slotweave.sources.json_documents import is_plain, json_records

FORMATS = ("csv", "json", "parquet")
# Texts that mean "missing" in a CSV cell.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
LIST_COLUMNS = ("attributes", "tokens", "bioes_tags", "attributes_pred")
MAX_FIELDS = 1000
_RAW = "_raw_record"
_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def format_of(path: str, fmt: str | None = None) -> str:
    """The given format, else the one the file name ends in; anything unknown is an error."""
    name = (fmt or PurePosixPath(path.rstrip("/")).suffix.lstrip(".")).lower()
    if name not in FORMATS:
        raise ValueError(f"unsupported format {name!r} for {path}: use one of {', '.join(FORMATS)}")
    return name


def missing_to_null(value: Column) -> Column:
    """NULL for texts that mean "missing"."""
    return F.when(~value.isin(*MISSING_TEXTS), value)


def _header(spark: SparkSession, path: str, options: dict) -> list[str]:
    """Column names of the first line, exact; repeated names get a number."""
    first = spark.read.options(**options).csv(path, header=False).limit(1).collect()
    if not first:
        raise ValueError(f"{path} is empty")
    return numbered(first[0])


def _distinct_names(names: list[str]) -> list[str]:
    """Names of which no two differ by case only: required names keep theirs, later twins get a number."""
    taken = {name.lower() for name in names if name in ALTERNATE_NAMES}
    out = []
    for name in names:
        final, repeat = name, 0
        while name not in ALTERNATE_NAMES and final.lower() in taken:
            repeat += 1
            final = f"{name}.{repeat}"
        taken.add(final.lower())
        out.append(final)
    return out


def _csv_options(encoding: str, multi_line: bool) -> dict:
    return {**_DIALECT, "encoding": encoding, "multiLine": multi_line}


def read_csv_files(spark: SparkSession, path: str | Sequence[str], fallback: str | None = "cp1252") -> DataFrame:
    """CSV files with headers of their own, put together by name; each file is read by many tasks, line breaks in cells or not.

    A column that a file lacks is NULL in its rows; an alternate name counts as the required one where the file lacks that.
    Files are UTF-8 or else ``fallback``. Rows with surplus cells or broken bytes get an ``error``, as in ``read_csv``.
    """
    records, headers = csv_records(spark, path, fallback)
    catalogue = header_catalogue(headers)
    if not catalogue:
        raise ValueError(f"{path} is empty")
    rows, names = cells_by_name(records, headers, catalogue, _DIALECT)
    cells = {name: missing_to_null(F.get("cells", F.lit(k))) for k, name in enumerate(names)}
    error = F.coalesce(F.col(ERROR), cells.pop(ERROR)) if ERROR in cells else F.col(ERROR)
    final = _distinct_names(list(cells))
    return rows.select(*(cell.alias(name) for name, cell in zip(final, cells.values(), strict=True)), error.alias(ERROR))


def read_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = True, stream: bool = False,
    by_name: bool = False, positions: bool = False, **more,
) -> DataFrame:
    """CSV with a header; doubled quotes, line breaks inside quotes.

    A row with more cells than the header gets an ``error`` that ends in the raw record; a short row is filled with
    NULL. All files must have the same header: another one is an error when its file is read. Where names repeat, or
    differ by case only, headers cannot be compared, so only one file may be read. ``multi_line=False`` lets Spark split large
    files, for data without line breaks in cells. With ``stream`` the header comes from the files that are there.
    ``positions`` adds ``position_columns``. With ``by_name`` the files are those of ``read_csv_files``; an encoding besides UTF-8 is for files that are not UTF-8.
    """
    if by_name:
        if stream or positions or more:
            raise ValueError("files with different headers are read as a table, without further options")
        return read_csv_files(spark, path, "cp1252" if encoding.upper() == "UTF-8" else encoding)
    options = {**_csv_options(encoding, multi_line), **more}
    first = spark.read.options(**_csv_options(encoding, multi_line))
    names = _header(spark, path, _csv_options(encoding, multi_line))
    written = [cell for cell in first.csv(path, header=False).limit(1).collect()[0]]
    checked = written == names and len({name.lower() for name in names}) == len(names)
    if not checked and (stream or len(first.csv(path, header=False).inputFiles()) > 1):
        raise ValueError(f"{path}: column names repeat or are blank, so files cannot be told apart by their headers")
    source = spark.readStream if stream else spark.read
    return _read_cells(source, path, names, {**options, "header": True}, checked, positions)


def read_in_order(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """A CSV or Parquet table with the columns that tell each row's place in the files, for ``aligned``."""
    name = format_of(path, fmt)
    if name == "csv":
        return read_csv(spark, path, positions=True, **options)
    if name == "parquet":
        return spark.read.options(**options).parquet(path).select("*", *position_columns())
    raise ValueError("rows are aligned by place in CSV and Parquet files only")


def read_headless_csv(spark: SparkSession, path: str, names: list[str], encoding: str = "UTF-8", multi_line: bool = True) -> DataFrame:
    """CSV files without a header line, with the given column names."""
    return _read_cells(spark.read, path, names, _csv_options(encoding, multi_line), False)


def _read_cells(
    source: DataFrameReader | DataStreamReader, path: str, names: list[str], options: dict, checked: bool, positions: bool = False,
) -> DataFrame:
    """All cells as text, and an error for rows with more cells than names; for tables and streams.

    ``checked`` has Spark compare each file's header with the names; ``positions`` adds ``position_columns``.
    """
    fields = names if checked else [f"_{k}" for k in range(len(names))]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*fields, _RAW)])
    raw = source.schema(schema).options(
        **options, enforceSchema=not checked, columnNameOfCorruptRecord=_RAW, columnPruning=False).csv(path)
    cells = [missing_to_null(F.col(f"`{field}`")).alias(name) for field, name in zip(fields, _distinct_names(names))]
    # Spark keeps the raw record of short rows as well; a wider reading tells them from long ones.
    wider = ", ".join(f"_{k} string" for k in range(len(names) + 1))
    surplus = F.from_csv(F.col(_RAW), wider, {**_DIALECT, "multiLine": "true"})[f"_{len(names)}"]
    error = F.when(surplus.isNotNull(), F.concat(F.lit(f"more than {len(names)} cells: "), F.col(_RAW)))
    if ERROR in names:
        error = F.coalesce(error, missing_to_null(F.col(f"`{fields[names.index(ERROR)]}`")))
        cells = [cell for name, cell in zip(names, cells) if name != ERROR]
    return raw.select(*cells, error.alias(ERROR), *(position_columns() if positions else ()))


def _field(record: Column, name: str) -> Column:
    """A field of a VARIANT record: NULL where it is missing, a VARIANT null where it is null."""
    quoted = name.replace("\\", "\\\\").replace('"', '\\"')
    return F.try_variant_get(record, f'$["{quoted}"]', "variant")


def _json_text(value: Column) -> Column:
    """Text of a VARIANT value; lists and objects are JSON."""
    kind, text = F.schema_of_variant(value), value.try_cast("string")
    return (
        F.when(F.is_variant_null(value), None)
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), number_text(value.try_cast("double")))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(value))
        .otherwise(text)
    )


def _further_names(raw: DataFrame) -> list[str]:
    """Names of the records' fields besides those of a query, by one pass; more than ``MAX_FIELDS`` are an error."""
    keys = F.explode(F.map_keys(F.try_variant_get("record", "$", "map<string, variant>"))).alias("key")
    found = [row.key for row in raw.select(keys).distinct().limit(MAX_FIELDS + 1).collect()]
    if len(found) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} different fields: name the ones to keep")
    known = {*ALTERNATE_NAMES, *ALTERNATE_NAMES.values(), ERROR}
    return sorted(name for name in found if name not in known)


def _json_rows(source: DataFrameReader | DataStreamReader, path: str, whole_document: bool, encoding: str, more: dict) -> DataFrame:
    """(record variant, _corrupt_record string) by Spark's own splitting: lines, or files that are one task each."""
    raw = (
        source.schema("record variant, _corrupt_record string")
        .options(singleVariantColumn="record", multiLine=whole_document, encoding=encoding, **more)
        .json(path)
    )
    if not whole_document:
        return raw
    listed = F.coalesce(F.col("record").try_cast("array<variant>"), F.array("record"))
    return raw.select(F.explode_outer(listed).alias("record"), "_corrupt_record")


def read_json(
    spark: SparkSession, path: str, whole_document: bool = False, encoding: str = "UTF-8",
    further: Sequence[str] | None = None, stream: bool = False, **more,
) -> DataFrame:
    """JSON lines, or with ``whole_document`` one list of records per file.

    Large documents are read by many tasks each, as ``json_records`` says; in a stream, with options of Spark's reader or in
    UTF-16 and other wide encodings, a document is one task.
    ``attributes`` is a VARIANT: text and lists may be mixed from row to row. Of a query's columns the exact name wins
    wherever it occurs, also with null. ``further`` names the other fields to keep, as text; without it a table keeps
    all, which takes a pass over the records, and a stream none. A line that repeats a key is not JSON to Spark, unless
    ``spark.sql.variant.allowDuplicateKeys`` is set, by which the last value counts.
    """
    if whole_document and not (stream or more) and is_plain(encoding):
        raw = json_records(spark, path, encoding)
    else:
        raw = _json_rows(spark.readStream if stream else spark.read, path, whole_document, encoding, more)
    if further is None:
        further = [] if stream else _further_names(raw)
    record = F.col("record")
    values = {name: F.coalesce(_field(record, name), _field(record, ALTERNATE_NAMES[name])) for name in ALTERNATE_NAMES}
    attributes = values.pop("attributes").alias("attributes")
    final = _distinct_names([*ALTERNATE_NAMES, ERROR, *further])[len(ALTERNATE_NAMES) + 1:]
    names, cells = [*values, *final], [*values.values(), *(_field(record, name) for name in further)]
    error = F.when(F.col("_corrupt_record").isNotNull(), F.concat(F.lit("not JSON: "), F.col("_corrupt_record")))
    texts = raw.select(F.transform(F.array(*cells), _json_text).alias("_texts"), attributes, error.alias(ERROR))
    return texts.select(*(F.get("_texts", F.lit(k)).alias(name) for k, name in enumerate(names)), "attributes", ERROR)


def read_queries(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """A query table; a missing path, an empty table and an unknown format are errors."""
    name = format_of(path, fmt)
    if name == "csv":
        df = read_csv(spark, path, **options)
    elif name == "json":
        df = read_json(spark, path, **options)
    else:
        df = spark.read.options(**options).parquet(path)
    if df.isEmpty():
        raise ValueError(f"{path} is empty")
    return df


def add_reader_options(parser: ArgumentParser) -> None:
    """Options of the readers for a command line."""
    parser.add_argument("--encoding", default="UTF-8", help="of CSV and JSON files")
    parser.add_argument("--single-line", action="store_true", help="CSV cells hold no line breaks: large files can be split")
    parser.add_argument("--by-name", action="store_true", help="CSV files may differ in headers and encoding; large ones are split")
    parser.add_argument("--whole-document", action="store_true", help="JSON files hold one list of records each")


def reader_options(args: Namespace, path: str, fmt: str | None = None) -> dict:
    """The options that the format of ``path`` has."""
    return {
        "csv": {"encoding": args.encoding, "multi_line": not args.single_line, "by_name": args.by_name},
        "json": {"encoding": args.encoding, "whole_document": args.whole_document},
        "parquet": {},
    }[format_of(path, fmt)]


def parse_list_text(text: Column) -> Column:
    """``array<string>`` of a list literal in JSON or Python notation; NULL for other text."""
    # Python writes \xNN where JSON wants \u00NN; a doubled backslash is no escape.
    escaped = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    return F.from_json(escaped, "array<string>", options)


def read_labelled(spark: SparkSession, path: str, fmt: str | None = None, more: str = "", **options) -> DataFrame:
    """Labelled sequences as they were written, list columns as arrays again.

    ``more`` names further fields of JSON lines with their types, as in "query_id bigint".
    """
    name = format_of(path, fmt)
    if name == "parquet":
        return spark.read.parquet(path)
    if name == "json":
        return spark.read.schema(
            "query string, brand string, attributes array<string>, product_type string, tokens array<string>, "
            "bioes_tags array<string>, augmented_query string, brand_added boolean, error string" + (more and f", {more}")
        ).json(path)
    df = read_csv(spark, path, **options)
    columns = []
    for column in df.columns:
        value = F.col(f"`{column}`")
        if column in LIST_COLUMNS:
            value = parse_list_text(value)
        elif column == "brand_added":
            value = F.lower(value).try_cast("boolean")
        columns.append(value.alias(column))
    return df.select(*columns)
