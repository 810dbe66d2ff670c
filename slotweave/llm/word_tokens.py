"""Token ids of whole texts by a tokenizer file, with a bounded table of the pieces of words.

The tokenizer drops white space and cuts words into pieces that it never merges across: letters, single digits, other
characters, and contractions. For a text of ASCII and Latin letters the pieces are found by arrays of character classes,
told apart by a 64-bit hash, and each piece that the table does not hold goes to the tokenizer's model once. Every other
text goes to the tokenizer as a whole.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np

from slotweave.llm.words import hash_spans

_PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-\u012f\u0132-\u017f]*")
_LETTERS, _NUMBERS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", r"0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_CODES = 0x180
CACHED_PIECES = 400_000
_LONG = 64


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of each code point of the plain texts."""
    lower = np.array([ord(low) if len(low := chr(c).lower()) == 1 and ord(low) < _CODES else c for c in range(_CODES)], np.uint16)
    kinds = ((re.compile(rf"[{_LETTERS}]"), _LETTER), (re.compile(rf"[{_NUMBERS}]"), _NUMBER))
    kind = [next((k for pattern, k in kinds if pattern.fullmatch(chr(c))), _OTHER) for c in lower.tolist()]
    kind = np.array(kind, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = _SPACE
    return kind, lower


def piece_starts(codes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the places where pieces begin, and of white space, in lower-cased text."""
    space = kind == _SPACE
    begins = kind == _NUMBER
    begins[1:] |= kind[1:] != kind[:-1]
    begins[:1] = True
    quote = np.flatnonzero(begins & (codes == ord("'")))
    after = np.concatenate([codes, [0, 0]])
    one, two = after[quote + 1], after[quote + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for at, length in ((quote[short], 2), (quote[long], 3)):
        begins[at + 1] = False
        rest = at + length
        begins[rest[rest < len(codes)]] = True
    return begins & ~space, space


def _visible_bytes() -> list[str]:
    """The character that stands for each byte: itself if it is a visible one, else the next free one from 256 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in seen else next(free)) for b in range(256)]


_VISIBLE = _visible_bytes()


class WordTokenizer:
    """One per Python worker; not shared between threads."""

    def __init__(self, path: str, pieces: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        self._bound = pieces
        self._forget()

    def vocabulary(self) -> dict[str, int]:
        return self._tokenizer.get_vocab(with_added_tokens=False)

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)  # sorted; piece k has the ids from first[k] on, count[k] of them
        self._first, self._count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Add pieces, by their hashes in order, that the table does not hold."""
        tokenize, learned, counts = self._model.tokenize, [], []
        for piece in pieces:
            shown = piece if piece.isascii() else "".join(map(_VISIBLE.__getitem__, piece.encode()))
            found = [t.id for t in tokenize(shown)]
            learned += found
            counts.append(len(found))
        count = np.array(counts, np.int64)
        at = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, at, hashes)
        self._first = np.insert(self._first, at, len(self._ids) + np.cumsum(count) - count)
        self._count = np.insert(self._count, at, count)
        self._ids = np.concatenate([self._ids, np.array(learned, np.uint32)])

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts, and where each text's ids begin."""
        joined = "\n".join([*texts, ""])
        of_code, lower = _tables()
        raw = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind, codes = of_code[raw], lower[raw]
        begins, space = piece_starts(codes, kind)
        start = np.flatnonzero(begins)
        stops = np.flatnonzero(begins | space)
        end = np.append(stops, len(codes))[np.searchsorted(stops, start, "right")]
        hashes = hash_spans(codes.view(np.uint8), 2 * start, 2 * (end - start))
        distinct, sample, where = np.unique(hashes, return_index=True, return_inverse=True)
        known = np.searchsorted(self._hashes, distinct)
        fresh = np.append(self._hashes, np.uint64(0))[known] != distinct
        fresh |= known == len(self._hashes)
        if fresh.any():
            if len(self._hashes) + fresh.sum() > self._bound:
                self._forget()
                fresh[:] = True
            lowered = codes.astype(np.uint16).tobytes().decode("utf-16-le")
            at = sample[fresh]
            self._learn(distinct[fresh], [lowered[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)])
            known = np.searchsorted(self._hashes, distinct)
        count, first = self._count[known][where], self._first[known][where]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self._ids[np.repeat(first - before[:-1], count) + np.arange(before[-1])]
        ends = np.cumsum([len(t) + 1 for t in texts])
        starts = before[np.searchsorted(start, np.concatenate([[0], ends]))]
        if ((end - start)[sample] > _LONG).any():
            self._forget()  # long pieces are not kept for the next texts
        return ids, starts

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids begin (one entry more than texts)."""
        odd = [k for k, t in enumerate(texts) if _PLAIN.fullmatch(t) is None]
        if not odd:
            return self._plain(texts)
        ids, starts = self._plain([t if _PLAIN.fullmatch(t) else "" for t in texts])
        parts = [ids[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        for k in odd:
            parts[k] = np.array(self._encode([texts[k]])[0], np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
