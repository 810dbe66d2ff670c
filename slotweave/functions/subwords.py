"""Sub-word pieces of tokens by longest match in a given vocabulary, with the token that each piece came from.

A vocabulary marks either the pieces that go on with a word ("##" before them) or those that end one ("</w>" behind them).
Both are held as one trie over words with one mark, at their beginning or end. Each batch looks its different words up
once; a worker keeps the words it has met, up to a bound.
"""

from __future__ import annotations

import json
import re
import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MARK = "\0"
KEPT_WORDS, KEPT_LENGTH = 200_000, 64
MAX_VOCABULARY_BYTES = 64 << 20
# Letters and digits in runs, every other visible character alone.
_PART = re.compile(r"[^\W_]+|\S")
# Names of special pieces in common vocabularies.
_BEGIN, _END = ("[CLS]", "<|startoftext|>", "<s>"), ("[SEP]", "<|endoftext|>", "</s>")
_PAD, _UNKNOWN = ("[PAD]", "<pad>"), ("[UNK]", "<unk>")


class Vocabulary(NamedTuple):
    """Pieces as marked texts with their ids; ids of special pieces, None where there is none."""

    pieces: dict[str, int]
    marks_begin: bool
    byte_level: bool = False
    begin: int | None = None
    end: int | None = None
    pad: int = 0
    unknown: int | None = None


def _special(names: tuple[str, ...], ids: dict[str, int]) -> int | None:
    return next((ids[name] for name in names if name in ids), None)


def _of_pieces(ids: dict[str, int], others: dict[str, int], prefix: str, suffix: str, byte_level: bool) -> Vocabulary:
    """``others`` are special pieces that are not part of ``ids``."""
    known = {**ids, **others}
    special = {name: _special(names, known) for name, names in
               (("begin", _BEGIN), ("end", _END), ("pad", _PAD), ("unknown", _UNKNOWN))}
    special["pad"] = special["pad"] or 0
    if special["unknown"] is None and not byte_level:
        raise ValueError("the vocabulary has no piece for unknown words")
    plain = {piece: i for piece, i in ids.items() if i not in set(special.values()) or byte_level}
    if suffix:
        pieces = {piece.removesuffix(suffix) + MARK if piece.endswith(suffix) else piece: i for piece, i in plain.items()}
    else:
        pieces = {piece[len(prefix):] if piece.startswith(prefix) and piece != prefix else MARK + piece: i
                  for piece, i in plain.items()}
    return Vocabulary(pieces, not suffix, byte_level, **special)


def read_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    """A vocabulary file: JSON of a tokenizer with pieces that end in a mark or begin with one, or a piece on each line.

    Other models' files, larger ones than ``MAX_VOCABULARY_BYTES`` and vocabularies without a piece for unknown words are errors.
    """
    files = spark.read.format("binaryFile").load(path)
    size = files.agg(F.sum("length")).first()[0] or 0
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: a vocabulary of {size} bytes is too large to broadcast")
    text = bytes(files.select("content").first()[0]).decode()
    if not text.lstrip().startswith("{"):
        lines = text.splitlines()
        return _of_pieces({line: number for number, line in enumerate(lines) if line}, {}, "##", "", False)
    file = json.loads(text)
    model = file["model"]
    prefix, suffix = model.get("continuing_subword_prefix") or "", model.get("end_of_word_suffix") or ""
    if not isinstance(model.get("vocab"), dict) or bool(prefix) == bool(suffix):
        raise ValueError(f"{path}: pieces must be marked where they begin or end a word")
    byte_level = '"ByteLevel"' in json.dumps(file.get("pre_tokenizer"))
    return _of_pieces(model["vocab"], {t["content"]: t["id"] for t in file.get("added_tokens") or ()}, prefix, suffix, byte_level)


def _byte_letters() -> list[str]:
    """The letter for each byte in byte-level vocabularies: the visible ones stand for themselves."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(1 << 8, 1 << 9))
    return [chr(byte) if byte in visible else chr(next(spare)) for byte in range(1 << 8)]


def _symbols(text: str) -> list[str]:
    """Letters of a marked text; the mark belongs to the letter beside it."""
    if text.startswith(MARK):
        return [text[:2], *text[2:]]
    return [*text[:-2], text[-2:]] if text.endswith(MARK) else [*text]


class PieceMatcher:
    """The trie of a vocabulary, and the words it has met."""

    def __init__(self, vocabulary: Vocabulary, lower: bool = True, strip_accents: bool = False):
        self._vocabulary, self._lower, self._strip = vocabulary, lower, strip_accents
        self._letters = _byte_letters()
        self._child: dict[tuple[int, str], int] = {}
        self._id: dict[int, int] = {}
        for piece, number in vocabulary.pieces.items():
            node = 0
            for letter in _symbols(piece):
                node = self._child.setdefault((node, letter), len(self._child) + 1)
            self._id[node] = number
        self._met: dict[str, list[int]] = {}

    def _matched(self, word: list[str]) -> list[int]:
        """Ids of the longest pieces from left to right; the unknown piece alone where nothing matches."""
        out, at, child, ids = [], 0, self._child, self._id
        while at < len(word):
            node, found, end = 0, None, at
            for k in range(at, len(word)):
                node = child.get((node, word[k]))
                if node is None:
                    break
                if node in ids:
                    found, end = ids[node], k + 1
            if found is None:
                return [] if self._vocabulary.unknown is None else [self._vocabulary.unknown]
            out.append(found)
            at = end
        return out

    def _parts(self, token: str) -> list[str]:
        token = unicodedata.normalize("NFC", token)
        if self._lower:
            token = token.lower()
        if self._strip:
            token = "".join(c for c in unicodedata.normalize("NFD", token) if unicodedata.category(c) != "Mn")
        parts = _PART.findall(token.replace(MARK, ""))
        if self._vocabulary.byte_level:
            parts = ["".join(self._letters[b] for b in part.encode(errors="replace")) for part in parts]
        return [MARK + part if self._vocabulary.marks_begin else part + MARK for part in parts]

    def pieces(self, token: str) -> list[int]:
        found = self._met.get(token)
        if found is None:
            found = [i for part in self._parts(token) for i in self._matched(_symbols(part))]
            if len(token) <= KEPT_LENGTH:
                if len(self._met) >= KEPT_WORDS:
                    self._met.clear()
                self._met[token] = found
        return found


def subwords(tokens: Column, vocabulary: Vocabulary, lower: bool = True, strip_accents: bool = False) -> Column:
    """struct<ids, word_ids>: the pieces of all tokens, and the number of the token of each.

    A null or blank token has no pieces; of a null array both lists are empty. Tokens of any length are matched whole.
    """
    shared = SparkSession.active().sparkContext.broadcast(vocabulary)
    matchers: list[PieceMatcher] = []  # one per worker process

    @F.arrow_udf("struct<ids: array<int>, word_ids: array<int>>")
    def match(batch: pa.Array) -> pa.Array:
        if not matchers:
            matchers.append(PieceMatcher(shared.value, lower, strip_accents))
        lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        coded = pc.fill_null(batch.flatten(), "").dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        lists = [matchers[0].pieces(word) for word in coded.dictionary.to_pylist()]
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.array([i for x in lists for i in x], np.int32)
        begins, word = np.cumsum(sizes) - sizes, coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[word]
        before = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat(begins[word] - before[:-1], counts) + np.arange(before[-1])]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        number = np.arange(ends[-1]) - np.repeat(ends[:-1], lengths)
        offsets = pa.array(before[ends].astype(np.int32))
        return pa.StructArray.from_arrays([
            pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(np.repeat(number, counts).astype(np.int32))),
        ], names=["ids", "word_ids"])

    return match(tokens)
