"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, and decoding.

The spans of pre-tokens, as byte offsets in the texts, are looked up in a bounded cache; spans that it lacks are merged
pair by pair, the lowest rank first and the leftmost of equals. Ids go back to bytes by one gather over the vocabulary.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slotweave.llm.pretokens import boundaries
from slotweave.llm.words import slices, text_bytes

CACHED_PIECES = 300_000
_LONG = 64


class Spelling:
    """Byte strings by number, put together for arrays of numbers."""

    def __init__(self, strings: list[bytes]):
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def join(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes in turn, and the place at which those of each number begin (and the end)."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[numbers] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.bytes[at], np.concatenate([[0], ends])


class Encoder:
    """One per Python worker."""

    def __init__(self, path: str, pieces: int = CACHED_PIECES):
        with open(path, "rb") as lines:
            self._ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        strings = [b""] * (max(self._ranks.values()) + 1)
        for token, rank in self._ranks.items():
            strings[rank] = token
        self.vocabulary = Spelling(strings)
        self.decimals = Spelling([b"%d," % k for k in range(len(strings))])
        self._bound = pieces
        self._forget()

    def _forget(self) -> None:
        self._number: dict[bytes, int] = {}
        self._ids = np.zeros(0, np.int32)
        self._ends = np.zeros(1, np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self._ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > _LONG:
            return self._merge_long(piece)
        ranks, none = self._ranks, len(self._ranks) + 1
        parts = [piece[k:k + 1] for k in range(len(piece))]
        pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            k = pairs.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], none)
            if k < len(pairs):
                pairs[k] = ranks.get(parts[k] + parts[k + 1], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same through a heap of (rank, place), for long pieces; places are linked both ways."""
        n, ranks = len(piece), self._ranks
        end, before, alive = list(range(1, n + 1)), list(range(-1, n)), [True] * n
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(piece[k:k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, to = heapq.heappop(heap)
            if not alive[k] or end[k] >= n or end[end[k]] != to:
                continue
            gone = end[k]
            alive[gone] = False
            end[k] = to
            if to < n:
                before[to] = k
                if (r := ranks.get(piece[k:end[to]])) is not None:
                    heapq.heappush(heap, (r, k, end[to]))
            if (p := before[k]) >= 0 and (r := ranks.get(piece[p:to])) is not None:
                heapq.heappush(heap, (r, p, to))
        return [ranks[piece[k:end[k]]] for k in range(n) if alive[k]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in turn, the place at which each text's ids begin (and the end), and each id's first byte.

        Byte offsets count from the start of the first text; null is an empty text.
        """
        if len(self._number) > self._bound:
            self._forget()
        data, offsets = text_bytes(texts)
        whole = data.tobytes()
        points = np.frombuffer(whole.decode().encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        begins = boundaries(points, np.searchsorted(lead, offsets))
        start = lead[begins]
        end = np.append(start, len(data))[1:]
        spans = [whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        number, fresh = self._number, []
        for s in dict.fromkeys(spans):
            if s not in number:
                number[s] = len(number)
                fresh.append(s)
        if fresh:
            merged = [self.merge(s) for s in fresh]
            self._ids = np.concatenate([self._ids, np.array([i for m in merged for i in m], np.int32)])
            self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum([len(m) for m in merged])])
        at = np.fromiter(map(number.__getitem__, spans), np.int64, len(spans))
        lengths = self._ends[at + 1] - self._ends[at]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = self._ids[np.repeat(self._ends[at] - before[:-1], lengths) + np.arange(before[-1])]
        sizes = self.vocabulary.lengths[ids]
        if any(len(s) > _LONG for s in fresh):
            self._forget()  # long pieces are not kept
        return ids, before[np.searchsorted(start, offsets)], np.cumsum(sizes) - sizes

    def decode(self, ids: np.ndarray) -> bytes:
        return self.vocabulary.join(ids)[0].tobytes()


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id, ``ids`` and ``offsets`` (first byte of each id in the text) of every document; null is an empty text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for piece in slices(batches, text):
            texts = piece.column(text)
            ids, starts, at = encoder.encode(texts)
            _, begin = text_bytes(texts)
            at = at - np.repeat(begin[:-1], np.diff(starts))
            ends = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(at, pa.int64()))], names=["doc_id", "ids", "offsets"])

    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<long>")


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids (decimal, with commas) and of the bytes they decode to."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for piece in slices(batches, text):
            ids, starts, _ = encoder.encode(piece.column(text))
            rows = []
            for spelling, cut in ((encoder.decimals, 1), (encoder.vocabulary, 0)):
                joined, at = spelling.join(ids)
                joined, at = joined.tobytes(), at[starts].tolist()
                rows.append([sha256(joined[a:max(a, b - cut)]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(np.diff(starts), pa.int64()), pa.array(rows[0], pa.string()),
                 pa.array(rows[1], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
