"""Quotation linking: conversations in reply order, without the text that replies repeat.

A line's quote level is the number of ">" before it. Runs of lines of one level are quoted passages; what has level 0
is the message's own text. Passages are normalised to lower-case words and hashed, and so are the own texts as a whole,
their paragraphs and their lines. A passage belongs to the first message of its conversation with that hash, if that
is an earlier one. Quotes of a part of a line, or wrapped at other places, are found by their sentences and by windows of
``WINDOW`` words, of every ``CHOSEN`` in a row the one with the least hash: two texts with ``WINDOW + CHOSEN - 1`` words in
common have a chosen window in common. Only conversations in which someone quotes are cut that way. First messages are found by an aggregation, so a line that thousands of messages share is one row
when passages are joined to it, and each passage meets one row at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.llm.shared import written
from slotweave.llm.words import slices

_MARKS = re.compile(r"(?:[ \t]{0,3}>)+[ \t]?")
_WORDS = re.compile(r"[^\W_]+")
#: Lines that announce a quote.
_ANNOUNCES = re.compile(r"(?:On|Am|Le|El)\b.*\b(?:wrote|schrieb|a écrit|escribió)[^:]*:\s*")


WINDOW, CHOSEN = 6, 4
_SENTENCE_WORDS = 3
_SENTENCE_END = re.compile(r"[.!?]+(?:\s+|$)")
_RESULTS = ("own_text", "own_keys", "quoted", "parts", "reply_to", "thread", "depth", "n_quotes", "n_linked")


class Message(NamedTuple):
    """Own text; keys of the own text and its parts; quoted passages and lines, and parts of passages, as (level, key)."""

    own: str
    keys: list[int]
    quoted: list[tuple[int, int]]
    parts: list[tuple[int, int]]


def key_of(text: str) -> int | None:
    """Hash of the words in lower case; None without words."""
    words = _WORDS.findall(text.lower())
    if not words:
        return None
    return _hash(words)


def _hash(words: list[str]) -> int:
    return int.from_bytes(blake2b(" ".join(words).encode(), digest_size=8).digest(), "little", signed=True)


def part_keys(text: str) -> list[int]:
    """Hashes of sentences of three words and more, and of the chosen windows; of fewer words than a window there is none."""
    found = {k for t in _SENTENCE_END.split(text) if len(_WORDS.findall(t)) >= _SENTENCE_WORDS and (k := key_of(t)) is not None}
    words = _WORDS.findall(text.lower())
    windows = [_hash(words[k:k + WINDOW]) for k in range(len(words) - WINDOW + 1)]
    found.update(min(windows[k:k + CHOSEN]) for k in range(max(len(windows) - CHOSEN + 1, min(len(windows), 1))))
    return sorted(found)


def _keys(texts: list[str]) -> list[int]:
    return sorted({k for t in texts if (k := key_of(t)) is not None})


def parse(text: str) -> Message:
    """Split a message; passages without words are dropped, and a line that announces a quote is not own text."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    level = 0
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        before, level = level, marks[0].count(">") if marks else 0
        if not marks:
            own.append(line)
            continue
        if before == 0 and own and _ANNOUNCES.fullmatch(own[-1]):
            own.pop()
        if before != level:
            passages.append((level, []))
        passages[-1][1].append(line[marks.end():])
    kept = "\n".join(own).strip("\n") if passages else text
    parts = [kept, *re.split(r"\n[ \t]*\n", kept), *kept.split("\n")]
    quoted, cut = [], []
    for depth, lines in passages:
        whole = key_of("\n".join(lines))
        cut += [(depth, k) for k in part_keys("\n".join(lines))]
        quoted += [(depth, k) for k in dict.fromkeys([whole, *map(key_of, lines)]) if k is not None]
    return Message(kept, _keys(parts), quoted, cut)


def parsed_messages(messages: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, then ``own_text``, ``own_keys``, ``quoted`` and ``parts``; a null text is an empty one.

    Columns that have the name of one of the results give way to it.
    """
    others = [c for c in messages.columns if c not in (text, *_RESULTS)]
    pairs = pa.list_(pa.struct([("level", pa.int32()), ("key", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            made = [parse(t or "") for t in piece.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *(piece.column(c) for c in others), pa.array([m.own for m in made], pa.string()),
                pa.array([m.keys for m in made], pa.list_(pa.int64())),
                *(pa.array([[{"level": a, "key": k} for a, k in found] for found in side], pairs)
                  for side in ([m.quoted for m in made], [m.parts for m in made])),
            ], names=[*others, "own_text", "own_keys", "quoted", "parts"])

    schema = messages.select(*(f"`{c}`" for c in others)).schema
    made = T.StructType.fromDDL(
        "own_text string, own_keys array<long>, quoted array<struct<level: int, key: long>>, "
        "parts array<struct<level: int, key: long>>")
    return messages.select(*(f"`{c}`" for c in others), text).mapInArrow(run, T.StructType([*schema, *made]))


def _cut_texts(parsed: DataFrame, asked: DataFrame) -> DataFrame:
    """(conv_id, turn, key) of the parts of all own texts in the conversations of ``asked``."""
    texts = parsed.where("turn is not null").join(asked.select("conv_id").distinct(), "conv_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "own_text"):
            keys = pa.array([part_keys(t) for t in piece.column("own_text").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([piece.column("conv_id"), piece.column("turn"), keys], names=["conv_id", "turn", "keys"])

    schema = T.StructType([parsed.schema["conv_id"], parsed.schema["turn"], T.StructField("keys", T.ArrayType(T.LongType()))])
    return texts.select("conv_id", "turn", "own_text").mapInArrow(run, schema).select("conv_id", "turn", F.explode("keys").alias("key"))


def links(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_linked) of the messages that quote: the latest of the originals of the outermost level.

    ``n_linked`` counts the passages and lines that were found, one at least. Null conversations and turns have no links;
    rows of one conversation and turn are taken together; of equal texts the first is the original.
    """
    quoting = parsed.where("conv_id is not null and turn is not null and size(quoted) > 0")

    def side(column: str, part: bool) -> DataFrame:
        rows = quoting.select("conv_id", "turn", F.explode(column).alias("q"))
        return rows.select("conv_id", "turn", "q.level", "q.key", F.lit(part).alias("part"))

    quotes = written(side("quoted", False).union(side("parts", True)).distinct(), "quotes")
    asked = quotes.select("conv_id", "key").distinct()
    whole = parsed.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode("own_keys").alias("key"))
    originals = (
        whole.union(_cut_texts(parsed, asked)).groupBy("conv_id", "key").agg(F.min("turn").alias("first"))
        .join(asked, ["conv_id", "key"], "left_semi")
    )
    found = quotes.join(originals, ["conv_id", "key"]).where("first < turn")
    return found.groupBy("conv_id", "turn").agg(
        F.max(F.struct(-F.col("level"), "first")).alias("best"),
        F.greatest(F.count_if(~F.col("part")), F.lit(1)).cast("long").alias("n_linked"),
    ).select("conv_id", "turn", F.col("best.first").alias("reply_to"), "n_linked")


def threads(linked: DataFrame) -> DataFrame:
    """Append ``thread`` (the turn at which the chain of replies begins) and ``depth``; ways are halved each round."""
    state = written(linked.select(
        "conv_id", "turn", "reply_to", "n_linked", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = state.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        joined = written(state.join(up, ["conv_id", "thread"], "left").select(
            "conv_id", "turn", "reply_to", "n_linked", F.coalesce("above", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moved")), "threads")
        state = joined.drop("moved")
        if joined.where("moved").isEmpty():
            return state


def conversations(messages: DataFrame) -> DataFrame:
    """Every message with its own text, the turn it replies to, its thread, depth, and its numbers of quotes.

    Sorting by (conv_id, thread, turn) gives the reply order: a reply has a later turn than its original and the same
    thread. A message without a linked quote begins a thread of its own.
    """
    parsed = written(parsed_messages(messages), "messages")
    found = threads(links(parsed))
    return parsed.join(found, ["conv_id", "turn"], "left").select(
        *(f"`{c}`" for c in parsed.columns if c not in _RESULTS), "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.size("quoted").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "own_text")
