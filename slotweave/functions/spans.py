"""Span search and BIOES encoding on *marked lines*.

A marked line is a text ``" tok tok tok "``: the lower-cased tokens, each between
single spaces. A tagged position holds ``MARK + tag`` in place of its token. An entity
line is padded the same way. Tokens never hold ``MARK`` (cleaning turns it into a blank),
so one plain substring search finds the first run of *free* tokens that equals an entity,
and one ``overlay`` tags it. Both are linear in the text, also for documents of many
thousand words, and both compile; only the 80 % rule needs lambdas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotweave.functions.text import split_line, token_line

MARK = "\x1f"
OUTSIDE = "O"
LABELS = ("Brand", "Attribute", "ProductType")
TAGS = (OUTSIDE, *(f"{prefix}-{label}" for label in LABELS for prefix in "BIES"))

# Below five tokens a share of 80 % is reached by equal runs only.
_MIN_FUZZY_TOKENS = 5
_NUMBER = f"{MARK}[0-9]+"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def padded(line: Column) -> Column:
    """Lower-cased line between two spaces."""
    return F.concat(F.lit(" "), F.lower(line), F.lit(" "))


def entity_line(cleaned: Column) -> Column:
    """Padded token line of a cleaned entity text; two spaces for the empty text."""
    return padded(token_line(cleaned))


def token_count(line: Column) -> Column:
    """Number of tokens in a padded line that is not empty."""
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) - 1


def is_single(line: Column) -> Column:
    """Whether a padded line holds one token: its second space is its last character."""
    return F.locate(" ", line, 2) == F.length(line)


def span_line(entity: Column, label: str, mark: str = "") -> Column:
    """Padded line of the BIOES tags of one padded entity: `` S-x ``, or `` B-x I-x .. E-x ``."""
    inner = F.repeat(F.lit(f"{mark}I-{label} "), token_count(entity) - 2)
    return F.when(is_single(entity), F.lit(f" {mark}S-{label} ")).otherwise(
        F.concat(F.lit(f" {mark}B-{label} "), inner, F.lit(f"{mark}E-{label} "))
    )


def encode_span(length: Column, label: str) -> Column:
    """BIOES tags of one span of ``length`` tokens, as an array; empty for no tokens."""
    inner = F.array_repeat(F.lit(f"I-{label}"), length - 2)
    return (
        F.when(length < 1, F.array().cast("array<string>"))
        .when(length == 1, F.array(F.lit(f"S-{label}")))
        .otherwise(F.concat(F.array(F.lit(f"B-{label}")), inner, F.array(F.lit(f"E-{label}"))))
    )


def marked_line(tokens: Column, tags: Column) -> Column:
    """Marked line of token and tag arrays of equal length."""
    cells = F.zip_with(
        tokens, tags,
        lambda token, tag: F.when(tag == OUTSIDE, F.lower(token)).otherwise(F.concat(F.lit(MARK), tag)),
    )
    return F.concat(F.lit(" "), F.array_join(cells, " "), F.lit(" "))


def tag_line(marked: Column) -> Column:
    """Tags of a marked line, each between single spaces."""
    outside = F.regexp_replace(marked, f" [^ {MARK}][^ ]*", f" {OUTSIDE}")
    return F.replace(outside, F.lit(MARK), F.lit(""))


def exact_offset(marked: Column, entity: Column) -> Column:
    """0-based token index of the first free run equal to ``entity``; NULL if there is none."""
    position = F.instr(marked, entity)
    before = F.substring(marked, F.lit(1), position)
    return F.when((F.length(entity) > 2) & (position > 0), token_count(before))


def _pieces(words: Column) -> Column:
    """Parts of an entity, with the index each begins at: one more than the words that may differ, so one part stands unchanged."""
    size = F.size(words)
    n_pieces = (size / _MIN_FUZZY_TOKENS).cast("int") + 1

    def piece(number: Column) -> Column:
        begin = (number * size / n_pieces).cast("int")
        end = ((number + 1) * size / n_pieces).cast("int")
        return F.struct(begin.alias("begin"), F.slice(words, begin + 1, end - begin).alias("words"))

    return F.transform(F.sequence(F.lit(0), n_pieces - 1), piece)


def _piece_starts(numbered: Column, piece: Column) -> Column:
    """Starts of an entity that go with each place of one of its parts in a line of numbered cells."""
    def quoted(word: Column) -> Column:
        literal = F.replace(F.coalesce(word, F.lit(MARK)), F.lit(r"\E"), F.lit(r"\E\\E\Q"))
        return F.concat(F.lit(r"\Q"), literal, F.lit(r"\E"))

    # Only the first word is consumed: places may overlap.
    rest = F.transform(F.slice(piece["words"], F.lit(2), F.size(piece["words"])), lambda word: F.concat(F.lit(" "), quoted(word), F.lit(_NUMBER)))
    pattern = F.concat(
        F.lit("(?<= )"), quoted(F.get(piece["words"], F.lit(0))), F.lit(f"{MARK}([0-9]+)(?="), F.array_join(rest, ""), F.lit(" )"))
    return F.transform(F.regexp_extract_all(numbered, pattern, F.lit(1)), lambda place: place.cast("int") - piece["begin"])


def fuzzy_offset(cells: Column, words: Column) -> Column:
    """0-based index of the first free run in which at least 80 % of ``words`` stand in place.

    ``cells`` are the parts of a marked line, ``words`` the lower-cased entity tokens; neither holds blanks. Of the parts into which
    the words are cut at least one stands unchanged in such a run, so only runs around an unchanged part are looked at.
    """
    size, length = F.size(words), F.size(cells)

    def fits(start: Column) -> Column:
        run = F.slice(cells, start + 1, size)
        free = ~F.exists(run, lambda cell: F.startswith(cell, F.lit(MARK)))
        hits = F.size(F.filter(F.zip_with(run, words, lambda a, b: a == b), lambda same: same))
        return free & (hits * 5 >= size * 4)

    def starts(pieces: Column) -> Column:
        cell = F.transform(cells, lambda cell, k: F.concat(F.coalesce(cell, F.lit("")), F.lit(MARK), k.cast("string")))
        numbered = F.concat(F.lit(" "), F.array_join(cell, " "), F.lit(" "))
        found = let(numbered, lambda line: F.flatten(F.transform(pieces, lambda piece: _piece_starts(line, piece))))
        return F.array_sort(F.array_distinct(F.filter(found, lambda start: start.between(0, length - size))))

    def first(pieces: Column) -> Column:
        line = F.concat(F.lit(" "), F.array_join(cells, " ", ""), F.lit(" "))
        # Where no part occurs at all, no cell is numbered.
        occurs = let(line, lambda whole: F.exists(
            pieces, lambda piece: F.contains(whole, F.concat(F.lit(" "), F.array_join(piece["words"], " ", ""), F.lit(" ")))))
        return F.when(occurs, F.get(F.filter(starts(pieces), fits), F.lit(0)))

    return F.when(size == 0, F.lit(0)).when(length >= size, let(_pieces(words), first))


def _mark_fuzzy(marked: Column, entity: Column, label: str) -> Column:
    """Tag the first fuzzy run; the line stays as it is when there is none."""
    parts = F.struct(split_line(marked).alias("cells"), split_line(entity).alias("words"))

    def rebuilt(p: Column, start: Column) -> Column:
        cells = p["cells"]
        head = F.slice(cells, F.lit(1), start)
        tail = F.slice(cells, start + F.size(p["words"]) + 1, F.size(cells))
        span = split_line(span_line(entity, label, MARK))
        joined = F.array_join(F.concat(head, span, tail), " ")
        return F.concat(F.lit(" "), joined, F.lit(" "))

    def place(p: Column) -> Column:
        return let(fuzzy_offset(p["cells"], p["words"]), lambda start: rebuilt(p, start))

    return F.coalesce(let(parts, place), marked)


def mark_entity(marked: Column, entity: Column, label: str) -> Column:
    """Tag the first free occurrence of a padded ``entity`` in a marked line.

    Equal runs come first; only without one, and for long entities, the 80 % rule applies.
    """
    position = F.instr(marked, entity)
    exact = F.overlay(marked, span_line(entity, label, MARK), position, F.length(entity))
    return (
        F.when(F.length(entity) <= 2, marked)
        .when(position > 0, exact)
        .when(token_count(entity) >= _MIN_FUZZY_TOKENS, _mark_fuzzy(marked, entity, label))
        .otherwise(marked)
    )


def apply_bioes_tags(tokens: Column, tags: Column, entity: Column, label: str) -> Column:
    """Tag one entity, a cleaned text, in token and tag arrays."""
    marked = let(marked_line(tokens, tags), lambda line: mark_entity(line, entity_line(entity), label))
    return split_line(tag_line(marked))
