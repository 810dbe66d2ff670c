"""The column functions as temporary SQL functions, made from the same expressions.

A SQL function's body is the text of the column expression over its parameters, so Spark plans both alike: no Python
worker, and nothing is written twice. Spark keeps the parsed body, so a query that calls one does not send the expression over again.
Spark calls SQL functions neither inside the lambda of another function nor inside a generator: give them a column of their own.
A struct whose fields are selected one by one is computed once per field; ``inline(array(..))`` over such a column computes it once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.functions.attributes import attribute_list, clean_attribute_list, distinct_texts, parse_attributes
from slotweave.functions.entities import extract_entities, predicted_slots
from slotweave.functions.spans import (
    LABELS, apply_bioes_tags, encode_span, entity_line, exact_offset, fuzzy_offset, let, mark_entity, padded, span_line, tag_line,
)
from slotweave.functions.text import clean_text, contains_brand, is_brand_in_query, split_line, token_line, tokenize_query
from slotweave.operators.labeling import tag_attributes

_TEXTS = "ARRAY<STRING>"
_ENTITIES = "STRUCT<" + ", ".join(f"{label}: {_TEXTS}" for label in LABELS) + ">"
# A text literal, an operator in the form of a call, or a number that SQL has no literal for.
_TOKEN = re.compile(r"('(?:[^'\\]|\\.)*')|(?<![\w`])(and|or|in|[=<>!+*/%&|^~-]+)\(|\b(Infinity|NaN)\b", re.DOTALL)


class SqlFunction(NamedTuple):
    """Parameters with their types, the result's type, and the column function."""

    parameters: dict[str, str]
    result: str
    body: Callable[..., Column]


def sql_text(column: Column) -> str:
    """SQL text of an expression: as Spark shows it, with operators called by quoted names."""
    def plain(match: re.Match) -> str:
        literal, operator, number = match.groups()
        return literal or (f"`{operator}`(" if operator else f"double('{number}')")

    return _TOKEN.sub(plain, str(column).removeprefix("Column<'").removesuffix("'>"))


def _by_label(body: Callable[[str], Column]) -> Column:
    """The expression of the label that the parameter names; NULL for another one."""
    chosen = F.when(F.col("label") == LABELS[0], body(LABELS[0]))
    for label in LABELS[1:]:
        chosen = chosen.when(F.col("label") == label, body(label))
    return chosen


def _line(tokens: Column) -> Column:
    return padded(F.array_join(tokens, " "))


def label_query(query: Column, brand: Column, attributes: Column, product_type: Column) -> Column:
    """One query's ``tokens``, ``bioes_tags``, ``augmented_query`` and ``brand_added``, as ``label_queries`` gives them.

    ``attributes`` is the list that ``parse_attributes`` or ``clean_attribute_list`` returns; NULL is an empty one.
    """
    def cleaned() -> Column:
        return F.struct(clean_text(query).alias("query"), clean_text(brand).alias("brand"))

    def lines(c: Column) -> Column:
        found = contains_brand(c["brand"], c["query"])
        return F.struct(
            c["query"].alias("query"), c["brand"].alias("brand"), token_line(c["query"]).alias("line"),
            token_line(c["brand"]).alias("brand_line"), found.alias("found"),
            ((c["query"] != "") & (c["brand"] != "") & ~found).alias("append"))

    def marked(r: Column) -> Column:
        line = padded(r["line"])
        branded = F.when(r["found"], mark_entity(line, padded(r["brand_line"]), "Brand")).otherwise(line)
        entities = F.transform(F.coalesce(attributes, F.array().cast("array<string>")), entity_line)
        types = F.array(entity_line(clean_text(product_type)))
        typed = F.aggregate(types, tag_attributes(branded, entities), lambda done, entity: mark_entity(done, entity, "ProductType"))
        return let(typed, lambda m: result(r, m))

    def result(r: Column, m: Column) -> Column:
        def appended(base: Column, extra: Column) -> Column:
            return F.concat(base, F.when(r["append"], extra).otherwise(""))

        return F.struct(
            split_line(appended(r["line"], F.concat(F.lit(" "), r["brand_line"]))).alias("tokens"),
            split_line(appended(tag_line(m), span_line(padded(r["brand_line"]), "Brand"))).alias("bioes_tags"),
            appended(r["query"], F.concat(F.lit(" "), r["brand"])).alias("augmented_query"), r["append"].alias("brand_added"))

    return let(cleaned(), lambda c: let(lines(c), marked))


FUNCTIONS = {
    "clean_text": SqlFunction({"text": "STRING"}, "STRING", clean_text),
    "tokenize_query": SqlFunction({"query": "STRING"}, _TEXTS, tokenize_query),
    "is_brand_in_query": SqlFunction({"brand": "STRING", "query": "STRING"}, "BOOLEAN", is_brand_in_query),
    "parse_attributes": SqlFunction({"text": "STRING"}, _TEXTS, parse_attributes),
    "clean_attribute_list": SqlFunction({"items": _TEXTS}, _TEXTS, clean_attribute_list),
    "distinct_texts": SqlFunction({"items": _TEXTS}, _TEXTS, distinct_texts),
    "variant_attributes": SqlFunction({"value": "VARIANT"}, _TEXTS, lambda value: attribute_list(value, T.VariantType())),
    "exact_span": SqlFunction(
        {"tokens": _TEXTS, "words": _TEXTS}, "INT", lambda tokens, words: exact_offset(_line(tokens), _line(words))),
    "fuzzy_span": SqlFunction(
        {"tokens": _TEXTS, "words": _TEXTS}, "INT",
        lambda tokens, words: fuzzy_offset(F.transform(tokens, F.lower), F.transform(words, F.lower))),
    "encode_span": SqlFunction(
        {"n_tokens": "INT", "label": "STRING"}, _TEXTS, lambda n_tokens, label: _by_label(lambda name: encode_span(n_tokens, name))),
    "apply_bioes_tags": SqlFunction(
        {"tokens": _TEXTS, "tags": _TEXTS, "entity": "STRING", "label": "STRING"}, _TEXTS,
        lambda tokens, tags, entity, label: _by_label(lambda name: apply_bioes_tags(tokens, tags, entity, name))),
    "label_query": SqlFunction(
        {"query": "STRING", "brand": "STRING", "attributes": _TEXTS, "product_type": "STRING"},
        f"STRUCT<tokens: {_TEXTS}, bioes_tags: {_TEXTS}, augmented_query: STRING, brand_added: BOOLEAN>", label_query),
    "extract_entities": SqlFunction({"tokens": _TEXTS, "tags": _TEXTS}, _ENTITIES, extract_entities),
    "predicted_slots": SqlFunction(
        {"entities": _ENTITIES}, f"STRUCT<brand_pred: STRING, attributes_pred: {_TEXTS}, product_type_pred: STRING>",
        lambda entities: F.struct(*predicted_slots(entities))),
}


def register_sql_functions(spark: SparkSession, names: Iterable[str] = tuple(FUNCTIONS), prefix: str = "") -> list[str]:
    """Create the named functions as temporary ones of this session, each with ``prefix`` before its name; returns those names.

    Functions of the same names in this session are replaced.
    """
    created = []
    for name in names:
        function = FUNCTIONS[name]
        parameters = ", ".join(f"{parameter} {kind}" for parameter, kind in function.parameters.items())
        body = sql_text(function.body(*(F.col(parameter) for parameter in function.parameters)))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {function.result} RETURN {body}")
        created.append(f"{prefix}{name}")
    return created
