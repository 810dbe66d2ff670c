"""Personal data behind disguises, at its place in the source text.

A text goes through transducers. The identity leaves it as it is; the second one rewrites homoglyphs to the ASCII
characters they look like, spelled digits to digits, and disguises such as "(at)" and " dot " to the characters meant.
What a transducer puts out keeps an alignment, piece by piece, with the characters it read. The same detectors run on
both outputs, and each span goes back through the alignment to code points of the source.

Spans found on the identity always stay; one found behind a disguise is added unless one of them covers it, and
redaction takes the union of all. A bare "at" makes an address only if what stands before it is no common word, and its
dots are spelled too, or other evidence is there (``_is_address``). Detection
looks at each position a bounded number of times, whatever the text: runs of one character class are never rescanned.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from slotweave.llm.words import slices

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Characters of other scripts, and the ASCII character each looks like.
HOMOGLYPHS = dict(zip(
    "аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅαοενιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ․。．＠﹫‐‑‒–−",
    "aeopcyxijshdqwABEKMHOPCTXIJSaoeviABEZHIKMNOPTYX...@@-----", strict=True))
#: Spelled digits.
DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
          "seven": "7", "eight": "8", "nine": "9"}
#: Words that stand before "at" in prose, never a name.
BEFORE_AT = frozenset(
    "i you he she it we they me him her us them this that these those one two who what all both some any none look looks "
    "looked looking see saw seen meet met is are was were be been am stay live lived work works worked arrive arrived aim "
    "aimed sit sat stand stood stop stopped start started available sold hosted found held located based shop buy read "
    "laugh point pointed good bad better best not only here there home out up down now then today sale more less even".split())
_LEAD = re.compile(r"(?:e-?mail|mail|contact|write|reach|address|adresse|correo|courriel|kontakt)\W{1,3}(?:(?:me|us|to|is)\W{1,2})?$|[:<=]\s?$", re.IGNORECASE)
_BARE_AT = re.compile(r"(?<![(\[{<]) at (?![)\]}>])", re.IGNORECASE)
_SPELLED_DOT = re.compile(r"[ (\[{<]dot[ )\]}>]", re.IGNORECASE)

_GLYPHS = "".join(re.escape(c) for c in HOMOGLYPHS)
_WORD = r"(?<![A-Za-z0-9])(?:" + "|".join(DIGITS) + r"|[0-9]{1,4})(?![A-Za-z0-9])"
_JOIN = r"(?: ?[-,.] ?| {1,2}dot {1,2}| {1,2})"
_DISGUISE = re.compile(
    rf"(?P<digits>(?:(?<![A-Za-z0-9])plus[ -]{{0,2}}|\+ ?)?{_WORD}(?:{_JOIN}{_WORD})+)"
    r"|(?P<at> ?[(\[{<] ?(?:at|@) ?[)\]}>] ?|(?<=[A-Za-z0-9]) at (?=[A-Za-z0-9-]+(?: dot | ?[(\[{<] ?dot|\.)))"
    r"|(?P<dot> ?[(\[{<] ?(?:dot|\.) ?[)\]}>] ?|(?<=[A-Za-z0-9]) dot (?=[A-Za-z0-9]))"
    rf"|(?P<glyphs>[{_GLYPHS}０-９Ａ-Ｚａ-ｚ]+)"
    r"|(?P<hidden>[​-‍⁠﻿­]+)", re.IGNORECASE)
_SPELLED = re.compile("|".join(DIGITS), re.IGNORECASE)


class Rewritten(NamedTuple):
    """A transducer's output; piece k begins at ``out[k]`` there and at ``source[k]`` in the source."""

    text: str
    out: list[int]
    source: list[int]
    changed: list[bool]


def _card(digits: str) -> bool:
    if not 14 <= len(digits) <= 19:
        return False
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """At each "@", the run of local characters before it (back to the last match) and a dotted domain behind it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        else:
            last = max(last, at)
        at = text.find("@", max(at + 1, last))


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four kinds as they stand, leftmost and non-overlapping within a kind."""
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(_at_most_255(p) for p in m[0].split("."))]
    found += [(m.start(), m.end(), "card") for m in _CARD.finditer(text)
              if m.end() - m.start() >= 14 and _card(_only_digits(m[0]))]
    if "+" in text:
        found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_only_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _plain(match: re.Match[str]) -> str:
    """What a disguise stands for."""
    piece = match[0]
    if match.lastgroup == "at":
        return "@"
    if match.lastgroup == "dot":
        return "."
    if match.lastgroup == "hidden":
        return ""
    if match.lastgroup == "glyphs":
        return "".join(HOMOGLYPHS.get(c) or chr(ord(c) - 0xFEE0) if ord(c) >= 0xFF10 else HOMOGLYPHS.get(c, c) for c in piece)
    if not _SPELLED.search(piece) and " dot " not in piece.lower():
        return piece
    lower = piece.lower()
    sign = "+" if lower.startswith(("plus", "+")) else ""
    parts = re.findall("|".join(DIGITS) + r"|[0-9]+|dot|\.", lower)
    return sign + "".join("." if p in ("dot", ".") else DIGITS.get(p, p) for p in parts)


def reveal(text: str) -> Rewritten | None:
    """The text without disguises, or None if it has none."""
    pieces, out, source, changed, at, size = [], [], [], [], 0, 0
    for match in _DISGUISE.finditer(text):
        plain = _plain(match)
        if plain == match[0]:
            continue
        for piece, begin, new in ((text[at:match.start()], at, False), (plain, match.start(), True)):
            pieces.append(piece)
            out.append(size)
            source.append(begin)
            changed.append(new)
            size += len(piece)
        at = match.end()
    if not pieces:
        return None
    pieces.append(text[at:])
    return Rewritten("".join(pieces), [*out, size], [*source, at], [*changed, False])


def to_source(r: Rewritten, start: int, end: int, length: int) -> tuple[int, int, bool]:
    """Source span of an output span, and whether any of it was rewritten; a rewritten piece counts as a whole."""
    first, last = bisect_right(r.out, start) - 1, bisect_right(r.out, end - 1) - 1
    a = r.source[first] if r.changed[first] else r.source[first] + start - r.out[first]
    if r.changed[last]:
        b = r.source[last + 1] if last + 1 < len(r.source) else length
    else:
        b = r.source[last] + end - r.out[last]
    return a, b, any(r.changed[first:last + 1])


def _is_address(text: str, start: int, end: int, local: str) -> bool:
    """Whether a span with a bare "at" is an address: by spelled dots, signs in the name, or a word that leads up to it."""
    if local.lower() in BEFORE_AT:
        return False
    if _SPELLED_DOT.search(text, start, end) or any(not c.isalpha() for c in local):
        return True
    return _LEAD.search(text[max(0, start - 24):start]) is not None


def find(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Spans as they stand, and all spans, both by start and then kind."""
    base = spans(text)
    revealed = reveal(text)
    if revealed is None:
        return base, base
    added = []
    for start, end, kind in spans(revealed.text):
        a, b, rewritten = to_source(revealed, start, end, len(text))
        if not rewritten or any(x <= a and b <= y for x, y, _ in base):
            continue
        if kind == "email" and _BARE_AT.search(text, a, b):
            if not _is_address(text, a, b, revealed.text[start:end].partition("@")[0]):
                continue
        added.append((a, b, kind))
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redact(text: str) -> str:
    """Each span gives way to its kind in brackets; of spans that meet, the first and longest names all they cover."""
    out, at = [], 0
    for start, end, kind in sorted(find(text)[1], key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, ``base`` and ``found``: lists of (start, end, kind), in code points, end exclusive; null is an empty text."""
    span = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    names = ("start", "end", "kind")

    def rows(lists: list[list[tuple[int, int, str]]]) -> pa.Array:
        return pa.array([[dict(zip(names, s, strict=True)) for s in x] for x in lists], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            both = [find(t or "") for t in piece.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), rows([x for x, _ in both]), rows([y for _, y in both])],
                names=["doc_id", "base", "found"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("base", span), T.StructField("found", span)])
    return docs.select("doc_id", text).mapInArrow(run, schema)


def redact_documents(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All columns, with redacted texts and their new lengths; a null text stays null, other rows stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            old = piece.column(text).to_pylist()
            new = [t if t is None else redact(t) for t in old]
            columns = {c: piece.column(c) for c in piece.schema.names}
            columns[text] = pa.array(new, piece.schema.field(text).type)
            if length in columns:
                same = pa.array([a == b for a, b in zip(old, new, strict=True)])
                sizes = pc.utf8_length(columns[text]).cast(piece.schema.field(length).type)
                columns[length] = pc.if_else(same, columns[length], sizes)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=piece.schema)

    return docs.mapInArrow(run, docs.schema)
