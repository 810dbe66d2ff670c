"""ProbMinHash signatures of weighted word shingles, for one slice of texts at a time.

A shingle with weight w sends arrivals of a Poisson process of rate w to random registers; a register keeps the
shingle of its earliest arrival. Two texts agree in a register with the probability Jaccard similarity

    J = sum over common shingles i of 1 / sum_j max(a_j / a_i, b_j / b_i).

Arrivals are made in rounds for all texts of a slice at once; a shingle stops as soon as its time is beyond the latest
register of its text, since no later arrival can change one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from slotweave.llm.words import LOWER_WORDS, find_words, hash_spans, mix, text_bytes, window_hashes

SHINGLE = 5
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingles(NamedTuple):
    """Distinct shingles of each text with their counts, ordered by text; and a digest of each text's words."""

    doc: np.ndarray
    key: np.ndarray
    count: np.ndarray
    digest: np.ndarray
    n_docs: int


def shingles(texts: pa.Array) -> Shingles:
    """Runs of five words in lower case; a text of one to four words is one shingle, one without words has none.

    Texts without words have the digest of their bytes, all others that of their sequence of words.
    """
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    mapped = LOWER_WORDS[data]
    words = find_words(mapped, offsets)
    hashes = hash_spans(mapped, words.start, words.length)
    key, at = window_hashes(hashes, words.doc, SHINGLE)
    doc = words.doc[at]
    n_words = np.bincount(words.doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(n_words)])
    place = (np.arange(len(hashes)) - first[words.doc]).astype(np.uint64)
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, words.doc, mix(hashes ^ mix(place + _STEP)))
    digest = mix(sums ^ n_words.astype(np.uint64))
    few = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    doc, key = np.concatenate([doc, few]), np.concatenate([key, digest[few]])
    none = np.flatnonzero(n_words == 0)
    digest[none] = hash_spans(data, offsets[none], offsets[none + 1] - offsets[none]) ^ _STEP
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    fresh = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else np.zeros(0, np.int64)
    return Shingles(doc[fresh], key[fresh], np.diff(np.append(fresh, len(doc))), digest, n)


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(s: Shingles) -> np.ndarray:
    """One row of registers per text; a register of a text without shingles is 0."""
    time = np.full(s.n_docs * REGISTERS, np.inf)
    owner = np.zeros(s.n_docs * REGISTERS, np.uint64)
    latest = np.full(s.n_docs, np.inf)
    doc, key, rate = s.doc, s.key, s.count.astype(np.float64)
    now, state = np.zeros(len(doc)), mix(key + _STEP)
    while len(doc):
        now = now - np.log(_uniform(state)) / rate
        register = (mix(state ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(57)).astype(np.int64)
        slot = doc * REGISTERS + register
        live = np.flatnonzero(now < latest[doc])
        np.minimum.at(time, slot[live], now[live])
        won = live[time[slot[live]] == now[live]]
        owner[slot[won]] = key[won]
        touched = np.unique(doc[won])
        latest[touched] = time.reshape(s.n_docs, REGISTERS)[touched].max(1)
        live = live[now[live] < latest[doc[live]]]
        doc, key, rate, now = doc[live], key[live], rate[live], now[live]
        state = mix(state[live] + _STEP)
    return owner.reshape(s.n_docs, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and text; the band's number is part of it."""
    cut = registers.reshape(len(registers), BANDS, ROWS)
    keys = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(registers), BANDS)).copy()
    for k in range(ROWS):
        keys = mix(keys * _STEP + cut[:, :, k])
    return keys


def probability_jaccard(a_key: np.ndarray, a: np.ndarray, b_key: np.ndarray, b: np.ndarray) -> float:
    """Exact similarity of two weighted sets with sorted keys; with equal weights it is |common| / |all|.

    For a common shingle, the sum of max(a_j / a_i, b_j / b_i) takes a_j / a_i where a_j / b_j > a_i / b_i: with
    all shingles in the order of a_j / b_j, both halves are running sums.
    """
    common, at_a, at_b = np.intersect1d(a_key, b_key, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[at_a].astype(np.float64), b[at_b].astype(np.float64)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    only_a, only_b = a.sum() - x.sum(), b.sum() - y.sum()
    above = only_a + x.sum() - np.cumsum(x)
    below = only_b + np.cumsum(y)
    return float((1 / (above / x + below / y)).sum())
