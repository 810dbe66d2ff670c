"""Attribute lists: loosely formatted text, native arrays, and mixed VARIANT columns.

Text is read by the first grammar that fits: a JSON list, a JSON object (its values),
the same two after ``'`` became ``"``, and at last three loose patterns. The JSON forms are
matched by regular grammars, so text that only *starts* like JSON is never half read.
A list or object that holds a non-empty list or object is left to the loose patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.functions.spans import let
from slotweave.functions.text import clean_text

# Texts that stand for "no attributes".
EMPTY_TEXTS = ("", "[]", "{}", "()", "nan")

# The JSON grammar for flat values. All repeats are possessive: no backtracking, no deep stacks.
_GAP = r"[ \t\n\r]*+"
_STRING = (
    r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
)
_NUMBER = r"-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+"
_SCALAR = f"(?:{_STRING}|{_NUMBER}|true|false|null|NaN|-?+Infinity)"
# Empty containers, and lists of one missing value, count as missing items.
_HOLLOW = rf"(?:\[{_GAP}(?:(?:null|NaN){_GAP})?+\]|\{{{_GAP}\}})"
_ITEM = f"(?:{_SCALAR}|{_HOLLOW})"
_PAIR = f"{_STRING}{_GAP}:{_GAP}{_ITEM}"

_LIST = rf"\[{_GAP}(?:{_ITEM}{_GAP}(?:,{_GAP}{_ITEM}{_GAP})*+)?+\]"
_OBJECT = rf"\{{{_GAP}(?:{_PAIR}{_GAP}(?:,{_GAP}{_PAIR}{_GAP})*+)?+\}}"
JSON_LIST = rf"\A{_GAP}{_LIST}{_GAP}\z"
FLAT_JSON = rf"\A{_GAP}(?:{_SCALAR}|{_LIST}|{_OBJECT}){_GAP}\z"

_LIST_ITEM = f"(?:\\G{_GAP}\\[|,){_GAP}({_ITEM})"
_OBJECT_PAIR = f"({_STRING}){_GAP}:{_GAP}({_ITEM})"
_MISSING_ITEM = r"\A(?:\"\"|false|null|NaN)\z|\A[\[{]"

# The loose patterns, in the order in which they are tried.
LOOSE_PATTERNS = (
    r"""['"]([^'"]*)['"]""",
    r"[\[\{\(]([^\]\}\)]+)[\]\}\)]",
    r"([^,\[\]\{\}\(\)]+)",
)



def _nothing() -> Column:
    return F.array().cast("array<string>")


def number_text(value: Column) -> Column:
    """Shortest decimal text of a double: ``1000.0``, ``1e+16``, ``1e-05``, ``inf``.

    The JVM writes exponents from 1e7 on and below 1e-3; they are spelled out up to 1e16
    and down to 1e-4. JVMs before version 19 write a few doubles with needless digits.
    """
    text = value.cast("string")
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    exponent = F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int")
    digits = F.regexp_replace(F.translate(text, "-.", ""), "0*E.*$", "")
    padded = F.rpad(digits, F.greatest(exponent + 2, F.length(digits)), "0")
    whole, tail = F.substring(padded, F.lit(1), exponent + 1), F.substr(padded, exponent + 2)
    fraction = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise("")
    power = F.concat(F.when(exponent < 0, "-").otherwise("+"), F.format_string("%02d", F.abs(exponent)))
    return (
        F.when(F.isnan(value), "nan")
        .when(F.abs(value) == float("inf"), F.concat(sign, F.lit("inf")))
        .when(exponent.isNull(), text)
        .when(exponent.between(0, 15), F.concat(sign, whole, F.lit("."), tail))
        .when(exponent == -4, F.concat(sign, F.lit("0.000"), digits))
        .otherwise(F.concat(sign, F.substring(digits, 1, 1), fraction, F.lit("e"), power))
    )


def _string_value(quoted: Column) -> Column:
    """Value of a JSON string, given with its quotes."""
    bare = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    unescaped = F.get_json_object(F.concat(F.lit("["), quoted, F.lit("]")), "$[0]")
    return F.when(F.contains(quoted, F.lit("\\")), unescaped).otherwise(bare)


def _item_text(item: Column) -> Column:
    """Text of a JSON item; NULL for items that count as missing (``null``, ``0``, ``""``, ..)."""
    number = item.try_cast("double")
    return (
        F.when(F.startswith(item, F.lit('"')), _string_value(item))
        .when(item == "true", "True")
        .when(F.rlike(item, F.lit(_MISSING_ITEM)) | (number == 0), None)
        .when(F.rlike(item, F.lit("[.eEy]")), number_text(number))
        .otherwise(item)
    )


def _list_items(text: Column) -> Column:
    """Items of a flat JSON list, as they are written."""
    return F.regexp_extract_all(text, F.lit(_LIST_ITEM), F.lit(1))


def _object_values(text: Column) -> Column:
    """Values of a flat JSON object, as they are written, by first use of the key, last value."""
    keys = F.transform(F.regexp_extract_all(text, F.lit(_OBJECT_PAIR), F.lit(1)), _string_value)
    values = F.regexp_extract_all(text, F.lit(_OBJECT_PAIR), F.lit(2))
    pairs = F.struct(keys.alias("keys"), values.alias("values"), F.reverse(keys).alias("backward"))

    def last_values(p: Column) -> Column:
        return F.transform(
            F.array_distinct(p["keys"]),
            lambda key: F.get(p["values"], F.size(p["keys"]) - F.array_position(p["backward"], key)),
        )

    return let(pairs, last_values)


def _json_items(text: Column) -> Column:
    """Item texts of flat JSON: of a list or the values of an object; a scalar has none."""
    written = (
        F.when(F.rlike(text, F.lit(rf"\A{_GAP}\[")), _list_items(text))
        .when(F.rlike(text, F.lit(rf"\A{_GAP}\{{")), _object_values(text))
        .otherwise(_nothing())
    )
    return F.transform(written, _item_text)


def _loose_items(text: Column) -> Column:
    """Items of the first loose pattern that matches at all."""
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) for pattern in LOOSE_PATTERNS]
    return (
        F.when(F.rlike(text, F.lit(LOOSE_PATTERNS[0])), found[0])
        .when(F.rlike(text, F.lit(LOOSE_PATTERNS[1])), found[1])
        .otherwise(found[2])
    )


def attribute_items(text: Column) -> Column:
    """Raw item texts of an attribute text, before cleaning; missing items are NULL."""
    requoted = F.replace(text, F.lit("'"), F.lit('"'))
    json = F.when(F.rlike(text, F.lit(FLAT_JSON)), text).when(
        F.contains(text, F.lit("'")) & F.rlike(requoted, F.lit(FLAT_JSON)), requoted
    )
    items = let(json, lambda z: F.when(z.isNotNull(), _json_items(z)).otherwise(_loose_items(text)))
    return F.when(text.isNull() | text.isin(*EMPTY_TEXTS), _nothing()).otherwise(items)


def _cleaned(items: Column) -> Column:
    return F.transform(items, clean_text)


def distinct_texts(items: Column) -> Column:
    """Drop empty texts and later repeats, keep the order."""
    return F.array_remove(F.array_distinct(items), "")


def parse_attributes(text: Column) -> Column:
    """Cleaned, distinct attributes of a loosely formatted text."""
    return distinct_texts(_cleaned(attribute_items(text)))


def clean_attribute_list(items: Column) -> Column:
    """Clean every item of an ``array<string>``; missing and empty items go, repeats stay."""
    kept = F.filter(F.coalesce(items, _nothing()), lambda item: item.isNotNull() & (item != ""))
    return _cleaned(kept)


def _typed_items(items: Column, element: T.DataType) -> Column:
    """Texts of the items of a native array; zero, false and NaN count as missing."""
    if isinstance(element, T.StringType):
        return items
    if isinstance(element, T.BooleanType):
        return F.transform(items, lambda item: F.when(item, "True"))
    if isinstance(element, (T.FloatType, T.DoubleType)):
        return F.transform(
            items,
            lambda item: F.when((item != 0) & ~F.isnan(item), number_text(item.cast("double"))),
        )
    if isinstance(element, (T.IntegralType, T.DecimalType)):
        return F.transform(items, lambda item: F.when(item != 0, item.cast("string")))
    raise TypeError(f"attributes: items of type {element.simpleString()} have no text form")


def _variant_item(item: Column) -> Column:
    """Text of one item of a VARIANT list; a nested list or object is its JSON text."""
    kind, text = F.schema_of_variant(item), item.try_cast("string")
    number = item.try_cast("double")
    return (
        F.when(F.is_variant_null(item), None)
        .when(kind == "BOOLEAN", F.when(text == "true", "True"))
        .when(F.startswith(kind, F.lit("DECIMAL")) | (kind == "DOUBLE"), F.when(number != 0, number_text(number)))
        .when(kind == "BIGINT", F.when(text != "0", text))
        .when(F.rlike(kind, F.lit("^(ARRAY|OBJECT)")), F.to_json(item))
        .otherwise(text)
    )


def _variant_items(value: Column) -> Column:
    """Row by row: text is parsed, a list is cleaned item by item, anything else is empty."""
    kind = F.schema_of_variant(value)
    listed = F.transform(F.try_variant_get(value, "$", "array<variant>"), _variant_item)
    return (
        F.when(kind == "STRING", parse_attributes(value.try_cast("string")))
        .when(F.startswith(kind, F.lit("ARRAY")), clean_attribute_list(listed))
        .otherwise(_nothing())
    )


def attribute_list(value: Column, data_type: T.DataType) -> Column:
    """Attributes of a column of any type; the type decides the reading at plan time."""
    if isinstance(data_type, T.StringType):
        return parse_attributes(value)
    if isinstance(data_type, T.ArrayType):
        return clean_attribute_list(_typed_items(value, data_type.elementType))
    if isinstance(data_type, T.VariantType):
        return _variant_items(value)
    return _nothing()
