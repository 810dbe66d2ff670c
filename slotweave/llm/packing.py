"""Packing of whole documents into sequences by order-preserving dynamic programming.

The ids of a block of documents, in table order, are one stream. A window of the stream becomes a sequence; windows
may end after a document (free), after a sentence, or, where neither is near, between any two ids (dearer). With
p the places at which a window may end and c what ending there costs,

    f(j) = c(j) + min over i with p(j) - p(i) <= size of f(i) + size - (p(j) - p(i)),

so the best i has the least f(i) + p(i) among those in reach: a queue kept in increasing order gives it in constant
time. A window of a power of two has no padding, which adds one look-up per power.

A block is a run of documents of one partition of the table as Spark reads it; it is closed after ``BLOCK_TOKENS``
ids, which bounds memory. Nothing is shuffled, and a lost task packs the same documents in the same way again.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from slotweave.llm.word_tokens import WordTokenizer
from slotweave.llm.words import slices

SIZE = 2048
BLOCK_TOKENS = 1 << 19
SENTENCE_COST, HARD_COST = 12.0, 48.0
_GAP, _STRIDE, _TAIL = 160, 64, 32
_POWERS = (64, 128, 256, 512, 1024)
END_OF_DOCUMENT = 1


def places(n: int, documents: np.ndarray, sentences: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end, in order, from 0 to n, and the cost of each; gaps and the tail get hard places."""
    known = np.unique(np.concatenate([[0, n], documents, sentences]))
    gaps = np.flatnonzero(np.diff(known) > _GAP)
    hard = [np.arange(known[k] + _STRIDE, known[k + 1], _STRIDE) for k in gaps.tolist()]
    hard.append(np.arange(n, max(n - size, 0), -_TAIL))
    place = np.unique(np.concatenate([known, *hard]))
    cost = np.full(len(place), HARD_COST)
    cost[np.searchsorted(place, sentences)] = SENTENCE_COST
    cost[np.searchsorted(place, np.concatenate([[0, n], documents]))] = 0
    return place, cost


def best_cuts(place: np.ndarray, cost: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The places at which the cheapest cover by windows is cut, first and last included."""
    p, c = place.tolist(), cost.tolist()
    where = {x: k for k, x in enumerate(p)}
    best, came = [0.0] * len(p), [0] * len(p)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(p)):
        here = p[j]
        while p[queue[0][1]] < here - size:
            queue.popleft()
        value, i = queue[0]
        value += size - here
        for power in _POWERS:
            k = where.get(here - power)
            if k is not None and best[k] <= value:
                value, i = best[k], k
        value += c[j]
        best[j], came[j] = value, i
        value += here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(p) - 1
    while j:
        cuts.append(p[j])
        j = came[j]
    return np.array([0, *reversed(cuts)], np.int64)


def sentence_ends(tokenizer: WordTokenizer) -> np.ndarray:
    """For each id, whether its token ends a sentence."""
    vocabulary = tokenizer.vocabulary()
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for t, i in vocabulary.items() if t.removesuffix("</w>")[:1] in (".", "!", "?") and t.endswith("</w>")]] = True
    return out


@cache
def _encoder(path: str) -> tuple[WordTokenizer, np.ndarray]:
    """Tokenizer and sentence ends, one of each per Python worker: the words met in one task serve the next."""
    tokenizer = WordTokenizer(path)
    return tokenizer, sentence_ends(tokenizer)


def pack_block(ids: np.ndarray, starts: np.ndarray, ends_sentence: np.ndarray) -> dict[str, np.ndarray]:
    """Pieces of a block; ``starts`` are the documents' first ids and the block's length."""
    place, cost = places(len(ids), starts[1:], np.flatnonzero(ends_sentence[ids]) + 1)
    cuts = best_cuts(place, cost)
    borders = np.unique(np.concatenate([cuts, starts]))
    first, last = borders[:-1], borders[1:]
    document = np.searchsorted(starts, first, "right") - 1
    sequence = np.searchsorted(cuts, first, "right") - 1
    whole = ids.astype("<u4", copy=False)
    return {
        "document": document, "start": first - starts[document], "length": last - first,
        "ids_crc32": np.array([zlib.crc32(whole[a:b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)], np.int64),
        "doc_tokens": (starts[1:] - starts[:-1])[document], "sequence": sequence, "offset": first - cuts[sequence],
        "sequence_tokens": (cuts[1:] - cuts[:-1])[sequence],
    }


def pack(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """One row per piece: its document, place there and place in its sequence.

    A null text is an empty one, and every document ends with the id ``END_OF_DOCUMENT``, so each has a piece.
    Only the document id and the text are used. Sequence ids are unique in the result, not without gaps.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, ends_sentence = _encoder(tokenizer_path)
        sequences = TaskContext.get().partitionId() << 32
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            nonlocal sequences
            doc_ids = pa.concat_arrays([h[0] for h in held])
            ids = np.concatenate([h[1] for h in held])
            starts = np.concatenate([[0], np.cumsum(np.concatenate([h[2] for h in held]))])
            held.clear()
            made = pack_block(ids, starts, ends_sentence)
            made["sequence_id"] = made.pop("sequence") + sequences
            sequences = int(made["sequence_id"][-1]) + 1
            return pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(made["document"])), *(pa.array(made[c].astype(np.int64)) for c in numbers)],
                names=["doc_id", *numbers])

        for piece in slices(batches, text):
            ids, starts = tokenizer.encode([t or "" for t in piece.column(text).to_pylist()])
            ids = np.insert(ids, starts[1:], END_OF_DOCUMENT)
            held.append((piece.column("doc_id"), ids, np.diff(starts) + 1))
            if sum(len(h[1]) for h in held) >= BLOCK_TOKENS:
                yield close()
        if held:
            yield close()

    return docs.select("doc_id", text).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"`{c}` long" for c in numbers))
