"""Decode BIOES tags back into entity texts, and project them to slots.

Each tag becomes a cell of fixed width: a letter for what it opens, continues or closes, and its position. The cells form
one line; the tokens themselves never enter it. An entity is a single-token tag, or an opening tag followed by inner tags
up to a closing tag; both are found by one linear pattern scan, and its tokens are a slice that begins at the position of
its first cell. Single-token tags inside an open span neither close it nor join it. An opening tag names the type,
closing and inner tags are not compared with it. Spans that never close are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotweave.functions.spans import LABELS, OUTSIDE, let

_DIGITS = 8
_CELL = _DIGITS + 1
# One letter for each label of single-token and of opening tags; the last is for other labels.
_SINGLE, _OPEN = "abcz", "pqry"
_INNER, _CLOSE, _NONE = "i", "e", "o"
_POSITION = f"\\d{{{_DIGITS}}}"
_INSIDE = f"(?:[{_INNER}{_SINGLE}]{_POSITION})*+"
_ENTITY = f"[{_OPEN}]{_POSITION}{_INSIDE}{_CLOSE}{_POSITION}|[{_SINGLE}]{_POSITION}"


def _letter(tag: Column) -> Column:
    """What a tag does: ``B-`` needs a label to open, the other prefixes do without."""
    known = F.create_map(*(
        F.lit(x) for letters, prefix in ((_SINGLE, "S"), (_OPEN, "B"))
        for letter, label in zip(letters, LABELS) for x in (f"{prefix}-{label}", letter)
    ), *(F.lit(x) for prefix, letter in (("I", _INNER), ("E", _CLOSE)) for label in LABELS for x in (f"{prefix}-{label}", letter)),
        F.lit(OUTSIDE), F.lit(_NONE))
    other = (
        F.when(F.startswith(tag, F.lit("S-")), _SINGLE[-1])
        .when(F.startswith(tag, F.lit("B-")) & (F.length(tag) > 2), _OPEN[-1])
        .when(F.startswith(tag, F.lit("I-")), _INNER)
        .when(F.startswith(tag, F.lit("E-")), _CLOSE)
        .otherwise(_NONE)
    )
    return F.coalesce(F.element_at(known, tag), other)


def _cells(tokens: Column, tags: Column) -> Column:
    """The cells of all tags in one line; the shorter list decides the length, a missing tag is outside."""
    size = F.least(F.size(tokens), F.size(tags))
    cells = F.transform(
        F.slice(tags, F.lit(1), size), lambda tag, k: F.concat(_letter(tag), F.lpad(k.cast("string"), _DIGITS, "0")))
    return F.array_join(cells, "")


def _label(cell: Column, match: Column, tags: Column) -> Column:
    """Label of the first cell: by its letter, or of another label the tag's own."""
    out = F.substring(F.get(tags, _position(match)), 3, 1 << 30)
    for letters in (_SINGLE, _OPEN):
        for letter, label in zip(letters, LABELS):
            out = F.when(cell == letter, label).otherwise(out)
    return out


def _position(match: Column) -> Column:
    return F.substring(match, 2, _DIGITS).cast("int")


def _entity(match: Column, letter: Column, words: Column, tags: Column) -> Column:
    return F.struct(_label(letter, match, tags).alias("label"), F.array_join(words, " ").alias("text"))


def _span_entities(match: Column, tokens: Column, tags: Column) -> Column:
    """Entities of one match, in the order in which they end: inner single tokens come first."""
    letter = F.substring(match, 1, 1)
    start, size = _position(match), (F.length(match) / _CELL).cast("int")
    words = F.transform(F.slice(tokens, start + 1, size), lambda token: F.coalesce(token, F.lit("")))
    plain = F.array(_entity(match, letter, words, tags))
    # Only a span with single tokens inside is looked at cell by cell.
    singles = F.regexp_extract_all(F.substring(match, _CELL + 1, 1 << 30), F.lit(f"[{_SINGLE}]{_POSITION}"), F.lit(0))
    places = F.transform(singles, _position)
    outer = F.filter(words, lambda _, k: ~F.array_contains(places, start + k))
    inner = F.transform(singles, lambda cell: _entity(
        cell, F.substring(cell, 1, 1), F.array(F.coalesce(F.get(tokens, _position(cell)), F.lit(""))), tags))
    mixed = F.concat(inner, F.array(_entity(match, letter, outer, tags)))
    return F.when(F.rlike(match, F.lit(f"^.+[{_SINGLE}]")), mixed).otherwise(plain)


def entity_list(tokens: Column, tags: Column) -> Column:
    """``array<struct<label, text>>`` in the order in which the entities end; a missing token is an empty text."""
    def entities(row: Column) -> Column:
        matches = F.regexp_extract_all(_cells(row["tokens"], row["tags"]), F.lit(_ENTITY), F.lit(0))
        return F.flatten(F.transform(matches, lambda match: _span_entities(match, row["tokens"], row["tags"])))

    return let(F.struct(tokens.alias("tokens"), tags.alias("tags")), entities)


def group_entities(entities: Column) -> Column:
    """Struct of one text array per label; entities of unknown labels are left out."""

    def texts(label: str) -> Column:
        of_label = F.filter(entities, lambda entity: entity["label"] == label)
        return F.transform(of_label, lambda entity: entity["text"]).alias(label)

    return F.struct(*(texts(label) for label in LABELS))


def extract_entities(tokens: Column, tags: Column) -> Column:
    """``struct<Brand, Attribute, ProductType>``, each an array of entity texts."""
    return let(entity_list(tokens, tags), group_entities)


def predicted_slots(entities: Column) -> list[Column]:
    """First brand, all attributes, first product type; '' where a single slot is empty."""
    return [
        F.coalesce(F.get(entities["Brand"], F.lit(0)), F.lit("")).alias("brand_pred"),
        entities["Attribute"].alias("attributes_pred"),
        F.coalesce(F.get(entities["ProductType"], F.lit(0)), F.lit("")).alias("product_type_pred"),
    ]
