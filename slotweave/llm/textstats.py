"""Structure counts of whole texts, for one slice of a batch at a time."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from slotweave.llm.words import SPACED_WORDS, Words, counts_by_doc, find_words, hash_spans, text_bytes, window_hashes

SYMBOLS = b"#*$%&|<>"


class Structure(NamedTuple):
    """One entry per text."""

    n_bytes: np.ndarray
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_lines: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    n_distinct_words: np.ndarray
    n_upper: np.ndarray
    n_lower: np.ndarray
    n_digits: np.ndarray
    n_marks: np.ndarray
    n_stops: np.ndarray


def _one_of(data: np.ndarray, members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table[data]


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Marks the keys that occur twice or more."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _repeat_words(hashes: np.ndarray, words: Words, n_docs: int) -> np.ndarray:
    keys, first = window_hashes(hashes, words.doc, 3)
    hit = first[_repeats(keys ^ (words.doc[first].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))]
    covered = np.zeros(len(words.doc), bool)
    for k in range(3):
        covered[hit + k] = True
    return np.bincount(words.doc[covered], minlength=n_docs)


def _line_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    whole, lines, repeated = data.tobytes(), [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        kept = [x for x in whole[a:b].split(b"\n") if x and not x.isspace()]
        lines.append(len(kept))
        repeated.append(len(kept) - len(set(kept)))
    return np.array(lines, np.int64), np.array(repeated, np.int64)


def structure(texts: pa.Array) -> Structure:
    """Words here are runs without ASCII white space, compared as they stand; null is an empty text."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    words = find_words(SPACED_WORDS[data], offsets)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    chars = lead[words.start + words.length] - lead[words.start]
    hashes = hash_spans(data, words.start, words.length)
    n_words = np.bincount(words.doc, minlength=n)
    salted = hashes ^ (words.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(salted)
    again = order[1:][salted[order][1:] == salted[order][:-1]]
    lines, repeated = _line_counts(data, offsets)
    return Structure(
        n_bytes=offsets[1:] - offsets[:-1],
        n_words=n_words,
        word_chars=np.bincount(words.doc, chars, n).astype(np.int64),
        n_symbols=counts_by_doc(_one_of(data, SYMBOLS), offsets),
        n_lines=lines,
        n_dup_lines=repeated,
        n_repeat_words=_repeat_words(hashes, words, n),
        n_distinct_words=n_words - np.bincount(words.doc[again], minlength=n),
        n_upper=counts_by_doc((data >= 0x41) & (data <= 0x5A), offsets),
        n_lower=counts_by_doc((data >= 0x61) & (data <= 0x7A), offsets),
        n_digits=counts_by_doc((data >= 0x30) & (data <= 0x39), offsets),
        n_marks=counts_by_doc(_one_of(data, b"!?"), offsets),
        n_stops=counts_by_doc(_one_of(data, b".,;:"), offsets),
    )
