"""Fill-in-the-middle: texts cut at token borders into prefix, middle and suffix, and put in another order.

Tokens are runs of ASCII letters and single other characters. Cuts are drawn as ranks of token borders by a digest of the
document's id, so every run draws the same. The place of a rank comes from a learned index: straight lines over ranks,
each within ``ERROR`` bytes of all the borders it covers, predict the place, and the stored residual of a byte corrects it
exactly. Lines are fitted to all borders of a slice of texts at once, over blocks of ranks that are halved until they fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.llm.words import counts_by_doc, slices, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
TRANSFORMED_PERCENT, SPM_PERCENT = 90, 20
SEED = 1
BLOCK, ERROR = 1024, 127


class RankIndex(NamedTuple):
    """Segments of ranks: first rank, place there, rise to the last rank and number of steps; a residual per rank."""

    first: np.ndarray
    place: np.ndarray
    rise: np.ndarray
    steps: np.ndarray
    residual: np.ndarray

    @staticmethod
    def _predicted(place: np.ndarray, rise: np.ndarray, steps: np.ndarray, after: np.ndarray) -> np.ndarray:
        return place + rise * after // np.maximum(steps, 1)

    @staticmethod
    def fit(places: np.ndarray, block: int = BLOCK, error: int = ERROR) -> RankIndex:
        """Lines through the first and last border of each block; where one misses by more than ``error``, two halves."""
        n, segments = len(places), []
        residual = np.zeros(n, np.int8)
        first = np.arange(0, n, block)
        last = np.minimum(first + block, n) - 1
        while len(first):
            steps = last - first
            rise = places[last] - places[first]
            lengths = steps + 1
            at = np.cumsum(lengths) - lengths
            after = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
            ranks = np.repeat(first, lengths) + after
            line = RankIndex._predicted(*(np.repeat(x, lengths) for x in (places[first], rise, steps)), after)
            off = places[ranks] - line
            fits = np.maximum.reduceat(np.abs(off), at) <= error
            inside = np.repeat(fits, lengths)
            residual[ranks[inside]] = off[inside]
            segments.append([x[fits] for x in (first, places[first], rise, steps)])
            first, last = first[~fits], last[~fits]
            middle = (first + last) // 2
            first, last = np.concatenate([first, middle + 1]), np.concatenate([middle, last])
        columns = [np.concatenate(c) for c in zip(*segments, strict=True)] if segments else [np.zeros(0, np.int64)] * 4
        order = np.argsort(columns[0])
        return RankIndex(*(c[order] for c in columns), residual)

    def places(self, ranks: np.ndarray) -> np.ndarray:
        """Exact places of the borders of these ranks."""
        segment = np.searchsorted(self.first, ranks, "right") - 1
        after = ranks - self.first[segment]
        return self._predicted(self.place[segment], self.rise[segment], self.steps[segment], after) + self.residual[ranks]


def _borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of all tokens."""
    letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(begins)


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """The first four groups of eight hexadecimal digits of the digest of ``seed:doc_id``; a null id is no text."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4]) for k in range(0, 16, 4)]


def _form(text: bytes, h3: int, h4: int) -> str:
    if not text or h3 % 100 >= TRANSFORMED_PERCENT or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return PLAIN
    return SPM if h4 % 100 < SPM_PERCENT else PSM


def _joined(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    if form == PLAIN:
        return prefix + middle + suffix
    return b"".join((p, prefix, s, suffix, m, middle) if form == PSM else (s, suffix, p, prefix, m, middle))


def transform(docs: DataFrame, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: ``key``, n (tokens), form, prefix_chars and middle_chars (null if plain) and output.

    A null text is an empty one and plain, and so stays a text that holds one of the marks. Texts of any length are one
    piece; rows with equal ids are cut at the same ranks if their texts have as many tokens; a null id draws as an empty
    one. Other columns are not used. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            data, offsets = text_bytes(piece.column(text))
            borders = _borders(data, offsets)
            before = np.searchsorted(borders, offsets)
            n = np.diff(before)
            index = RankIndex.fit(np.append(borders, len(data)))
            drawn = [draws(i, seed) for i in piece.column(key).to_pylist()]
            h = np.array([d[:2] for d in drawn], np.int64).reshape(-1, 2) % (n + 1)[:, None]
            # A text's last border is the next one's first: the place where it ends.
            cuts = index.places(before[:-1, None] + np.sort(h, axis=1))
            whole, forms, outputs = data.tobytes(), [], []
            for (a, b), (x, y), (_, _, h3, h4) in zip(
                    zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True), cuts.tolist(), drawn, strict=True):
                forms.append(_form(whole[a:b], h3, h4))
                outputs.append(_joined(forms[-1], whole[a:x], whole[x:y], whole[y:b]))
            plain = np.array([f == PLAIN for f in forms], bool)
            ends = np.stack([offsets[:-1], cuts[:, 0], cuts[:, 1]], axis=1).ravel()
            chars = np.diff(np.append(0, np.cumsum((data & 0xC0) != 0x80))[ends].reshape(-1, 3), axis=1)
            yield pa.RecordBatch.from_arrays(
                [piece.column(key), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(chars[:, 0], pa.int64(), mask=plain), pa.array(chars[:, 1], pa.int64(), mask=plain),
                 pa.array(outputs, pa.binary()).cast(pa.string())],
                names=[key, "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = T.StructType([docs.schema[key], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.StringType())])
    return docs.select(key, text).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; a mark stands in it once, as no part of one begins another."""
    def between(begin: str, end: str) -> Column:
        after = F.substring_index(output, begin, -1)
        return F.substring_index(after, end, 1)

    middle = F.substring_index(output, MIDDLE, -1)
    return (
        F.when(form == PSM, F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
        .when(form == SPM, F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
        .otherwise(output)
    )
