"""Words of Arrow text columns as numpy arrays: places, lengths and 64-bit hashes, without a loop over words.

Everything here works on one bounded slice of a batch at a time; a text longer than the bound is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_LONG = 1024
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _word_table() -> np.ndarray:
    """Maps a byte to its lower-case form, bytes that separate words to 0: words are digits, letters and all beyond ASCII."""
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low:high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


def _space_table() -> np.ndarray:
    """Maps white space of ASCII to 0 and every other byte to 1."""
    table = np.ones(256, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


LOWER_WORDS = _word_table()
SPACED_WORDS = _space_table()


class Words(NamedTuple):
    """One entry per word: its text's number in the slice, first byte and length in bytes."""

    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice have at most ``limit`` bytes, or are one text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the offsets at which texts begin; null is an empty text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def find_words(mapped: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of non-zero bytes; no run goes from one text into the next."""
    inside = mapped != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(mapped)]
    first[borders] = inside[borders]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = inside[ends]
    start = np.flatnonzero(first)
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(doc, start, np.flatnonzero(last) + 1 - start)


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit generator: every input bit changes every output bit."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_A
    values = (values ^ (values >> np.uint64(27))) * _MIX_B
    return values ^ (values >> np.uint64(31))


def hash_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = mix(length.astype(np.uint64) * _GOLDEN + np.uint64(1))
    live, at = np.arange(len(start)), 0
    while len(live):
        left = length[live] - at
        piece = words[start[live] + at]
        short = np.minimum(left, 8).astype(np.uint64)
        piece &= ~np.uint64(0) >> ((np.uint64(8) - short) * np.uint64(8))
        out[live] = mix((out[live] ^ piece) * _GOLDEN + np.uint64(at + 1))
        at += 8
        live = live[left > 8]
        if at == _LONG:
            for k in live.tolist():
                rest = padded[start[k] + at:start[k] + length[k]].tobytes()
                out[k] ^= np.frombuffer(blake2b(rest, digest_size=8).digest(), np.uint64)[0]
            break
    return out


def window_hashes(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within one text, and the number of each run's first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out = out * _GOLDEN + hashes[k:k + n]
    at = np.flatnonzero(doc[:n] == doc[width - 1:])
    return mix(out[at]), at


def counts_by_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text the mask marks."""
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]
