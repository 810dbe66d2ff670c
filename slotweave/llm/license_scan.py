"""License scans as an exact set-similarity join between text blocks and templates.

A text is cut into overlapping blocks of ``BLOCK`` words, one every ``STRIDE``. A block meets a template when it holds
at least the share ``THRESHOLD`` of the template's distinct words. All pairs that do are found without comparing all:

* words are put in one global order, rarest first, by the number of documents of the corpus that have them;
* of a template with n words, a of which are needed, one of the first n - a + 1 must be in the block (prefix filter),
  and likewise for the block's own words, of which only those of some template matter;
* a block with fewer than a words cannot meet it (length filter);
* a shared word at place i of the one list and j of the other leaves at most 1 + min of what follows (positional filter).

What passes is verified by the intersection of the two lists. Templates that are phrases must, beyond that, stand word
by word at a place; each place belongs to one block, so it is counted once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotweave.llm.words import LOWER_WORDS, slices, text_bytes

BLOCK, STRIDE, THRESHOLD = 64, 32, 0.8


class Template(NamedTuple):
    label: str
    text: str
    phrase: bool = False


#: Phrases that must stand as they are, and notices that may be changed in a fifth of their words.
TEMPLATES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
    Template("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of "
                           "the gnu general public license as published by the free software foundation"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the "
                       "license at"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files"),
    Template("mit", "released under the mit license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("creative-commons", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
)


def _table() -> bytes:
    return bytes(np.where(LOWER_WORDS == 0, 0x20, LOWER_WORDS).astype(np.uint8))


_FOLD = _table()


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case: runs of digits, ASCII letters and all code points beyond ASCII."""
    return text.translate(_FOLD).split()


def _texts(piece: pa.RecordBatch, column: str) -> Iterator[bytes]:
    data, offsets = text_bytes(piece.column(column))
    whole = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield whole[a:b]


def word_order(docs: DataFrame, templates: Sequence[Template], text: str = "text") -> list[bytes]:
    """The templates' words by the number of documents that have them, rarest first; ties by the word.

    Counts cover all documents and are summed before the shuffle; the driver gets one row per template word.
    """
    vocabulary = sorted({w for t in templates for w in words_of(t.text.encode())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = dict.fromkeys(vocabulary, 0)
        known = frozenset(vocabulary)
        for piece in slices(batches, text):
            for t in _texts(piece, text):
                for w in known.intersection(words_of(t)):
                    counts[w] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    got = docs.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = {bytes(r["word"]): r["n"] for r in got}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def _needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, threshold: float = THRESHOLD,
         text: str = "text") -> DataFrame:
    """(row, doc_id, n_words, match): one row per word of a block that may begin a match, one at least per document.

    ``match`` is null or (template, label, phrase, block, containment, places) of a block that meets a template; the
    places of a phrase in it may be none. A null text is empty. ``row`` keeps rows with equal or null ids apart.
    """
    spark = docs.sparkSession
    order = word_order(docs, templates, text)
    rank = {w: k for k, w in enumerate(order)}
    lists = [[rank[w] for w in words_of(t.text.encode())] for t in templates]
    rows, leading = [], set()
    for number, (t, spelled) in enumerate(zip(templates, lists, strict=True)):
        ordered = sorted(set(spelled))
        need = _needed(len(ordered), threshold)
        for place, token in enumerate(ordered[:len(ordered) - need + 1]):
            rows.append((token, number, t.label, t.phrase, place, need, ordered, spelled))
            leading.add(order[token])
    least = min((r[5] for r in rows), default=1)
    prefixes = spark.createDataFrame(
        rows, "token int, template int, label string, phrase boolean, t_at int, need int, t_tokens array<int>, spelled array<int>")
    found = pa.list_(pa.struct([
        ("block", pa.int32()), ("tokens", pa.list_(pa.int32())),
        ("hits", pa.list_(pa.struct([("at", pa.int32()), ("token", pa.int32())])))]))

    def blocks(words: list[bytes]) -> list[dict]:
        if leading.isdisjoint(words):
            return []
        hits = [(k, rank[w]) for k, w in enumerate(words) if w in rank]
        lead = {rank[w] for w in leading}
        numbers = sorted({b for k, r in hits if r in lead for b in (k // STRIDE - 1, k // STRIDE) if b >= 0})
        at, out = np.array([k for k, _ in hits]), []
        for b in numbers:
            inside = hits[int(np.searchsorted(at, b * STRIDE)):int(np.searchsorted(at, b * STRIDE + BLOCK))]
            out.append({"block": b, "tokens": sorted({r for _, r in inside}),
                        "hits": [{"at": k, "token": r} for k, r in inside]})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            words = [words_of(t) for t in _texts(piece, text)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([blocks(w) for w in words], found)], names=["doc_id", "n_words", "blocks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.select("doc_id", text).mapInArrow(
        run, f"doc_id {kind}, n_words long, "
             "blocks array<struct<block: int, tokens: array<int>, hits: array<struct<at: int, token: int>>>>")
    numbered = cut.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", "n_words", F.explode_outer("blocks").alias("b"))
    prefix = numbered.select("row", "doc_id", "n_words", "b", F.expr(
        f"posexplode_outer(slice(b.tokens, 1, greatest(size(b.tokens) - {least} + 1, 0))) as (b_at, token)"))
    pairs = prefix.join(F.broadcast(prefixes), "token", "left")
    passes = F.expr("""
        size(b.tokens) >= need
        and least(size(t_tokens) - t_at, size(b.tokens) - b_at) >= need
        and not arrays_overlap(slice(b.tokens, 1, b_at), t_tokens)
        and size(array_intersect(b.tokens, t_tokens)) >= need""")
    places = F.expr(f"""
        filter(transform(b.hits, (h, k) -> if(
            h.at < (b.block + 1) * {STRIDE}
            and forall(sequence(0, size(spelled) - 1), q -> get(b.hits, k + q).token = spelled[q]
                                                      and get(b.hits, k + q).at = h.at + q), h.at, null)), p -> p is not null)""")
    match = F.when(passes, F.struct(
        "template", "label", "phrase", F.col("b.block").alias("block"),
        (F.size(F.array_intersect("b.tokens", "t_tokens")) / F.size("t_tokens")).alias("containment"),
        F.when(F.col("phrase"), places).alias("places")))
    return pairs.select("row", "doc_id", "n_words", match.alias("match"))


def summary(matches: DataFrame) -> DataFrame:
    """One row per document: places of phrases, their labels, all labels and the best containment.

    A phrase counts where it stands word by word; a notice counts in every block that holds enough of its words.
    """
    counts = F.col("match.phrase") & (F.size("match.places") > 0)
    valid = counts | ~F.col("match.phrase")
    joined = lambda label: F.array_join(F.sort_array(F.collect_set(label)), ",")
    return matches.groupBy("row", "doc_id", "n_words").agg(
        F.coalesce(F.sum(F.when(counts, F.size("match.places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(counts, F.array_min("match.places"))).cast("long").alias("first_word"),
        F.max(F.when(counts, F.array_max("match.places"))).cast("long").alias("last_word"),
        joined(F.when(counts, F.col("match.label"))).alias("base_labels"),
        joined(F.when(valid, F.col("match.label"))).alias("labels"),
        F.coalesce(F.max(F.when(valid, F.col("match.containment"))), F.lit(0.0)).alias("score"),
    ).drop("row")
