"""Boundaries of pre-tokens without a regular expression.

Every code point has a class: letter, number, white space or other. With one or two code points of look-ahead it
becomes a symbol of a small automaton that reproduces the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

A symbol is a function from state to state. Functions are composed associatively, and the few that occur form a finite
table, so all prefixes of a slice of texts are found by a blocked scan of table look-ups over whole arrays.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np

_FRESH, _LETTERS, _NUMBERS, _OTHERS, _SPACE, _ONE_MORE, _TWO_MORE, _WHITE = range(8)
_L, _N, _O, _QUOTE1, _QUOTE2, _S, _A, _Z = range(8)
_BLOCK = 256


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a pre-token begins with the symbol.

    _S is white space with more white space or the end behind it, _A a space right before something else, which it
    joins, _Z other white space there, which stands alone; the quotes open a contraction of one or two letters.
    """
    if symbol == _L:
        if state == _TWO_MORE:
            return _ONE_MORE, False
        if state == _ONE_MORE:
            return _FRESH, False
        return _LETTERS, state not in (_LETTERS, _SPACE)
    if symbol == _N:
        return _NUMBERS, state not in (_NUMBERS, _SPACE)
    if symbol in (_O, _QUOTE1, _QUOTE2):
        if state in (_OTHERS, _SPACE):
            return _OTHERS, False
        return {_O: _OTHERS, _QUOTE1: _ONE_MORE, _QUOTE2: _TWO_MORE}[symbol], True
    if symbol == _S:
        return _WHITE, state != _WHITE
    return (_SPACE if symbol == _A else _FRESH), True


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Composition table, value from the fresh state, function of each symbol (as it is, at a text's start), and begins."""
    plain = [tuple(_step(q, s)[0] for q in range(8)) for s in range(8)]
    first = [(f[_FRESH],) * 8 for f in plain]
    functions, number = [tuple(range(8))], {tuple(range(8)): 0}
    for f in functions:
        for g in plain + first:
            h = tuple(g[q] for q in f)
            if h not in number:
                number[h] = len(functions)
                functions.append(h)
    table = np.array([[number[tuple(g[q] for q in f)] for g in functions] for f in functions], np.uint8)
    begins = np.array([[_step(q, s)[1] for s in range(8)] for q in range(8)])
    return (table, np.array([f[_FRESH] for f in functions], np.uint8),
            np.array([[number[f] for f in plain], [number[f] for f in first]], np.uint8), begins)


@cache
def _classes() -> np.ndarray:
    """Class of every code point, as the symbol of a run of it."""
    kinds = {"L": _L, "N": _N}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], _O) for c in range(sys.maxunicode + 1)], np.uint8)
    white = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[white] = _S
    return table


def _prefixes(functions: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Function of everything before each place."""
    n = len(functions)
    if n <= 1:
        return np.zeros(n, np.uint8)
    rows = -(-n // _BLOCK)
    padded = np.zeros(rows * _BLOCK, np.uint8)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, _BLOCK).T)
    whole = columns[0]
    for column in columns[1:]:
        whole = table[whole, column]
    out = np.empty_like(columns)
    before = _prefixes(whole, table) if rows > 1 else np.zeros(1, np.uint8)
    for k, column in enumerate(columns):
        out[k] = before
        before = table[before, column]
    return out.T.reshape(-1)[:n]


def boundaries(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks the code points at which a pre-token begins; ``starts`` are the texts' first places, and the end."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    table, from_fresh, of_symbol, begins = _monoid()
    first = np.zeros(n + 2, bool)
    first[starts[:-1][starts[:-1] < n]] = True
    first[n:] = True
    after = np.append(points, [0, 0])
    one = np.where(first[1:n + 1], 0, after[1:n + 1])
    two = np.where(first[1:n + 1] | first[2:], 0, after[2:])
    symbol = _classes()[points]
    white = symbol == _S
    ahead_white = np.append(white[1:], True) | first[1:n + 1]
    last = white & ~ahead_white
    symbol[last] = np.where(points[last] == 0x20, _A, _Z)
    quote = np.flatnonzero(points == 0x27)
    a, b = one[quote], two[quote]
    symbol[quote[np.isin(a, [ord(c) for c in "stmd"])]] = _QUOTE1
    pairs = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    symbol[quote[pairs]] = _QUOTE2
    functions = of_symbol[first[:n].astype(np.uint8), symbol]
    state = from_fresh[_prefixes(functions, table)]
    state[first[:n]] = _FRESH
    return begins[state, symbol]
