"""Largest eigenvalues and eigenvectors of an integer matrix, from its exact characteristic polynomial.

The matrix is symmetric and has no negative eigenvalue, as a scatter matrix. Its polynomial is found modulo many primes,
by a reduction to Hessenberg form each, and put together by the Chinese remainder theorem. All roots are real, so the
sign changes of the shifted polynomial's coefficients count the roots beyond a point exactly (Descartes), multiple roots
as often as they are. Bisection by that count isolates the roots; the sign of the polynomial then refines them. A null
vector of the matrix less a root comes from inverse iteration in integers of fixed scale.

All sizes depend on the order of the matrix alone.
"""

from __future__ import annotations

import math
import random
from typing import NamedTuple

import numpy as np

Matrix = list[list[int]]

#: Roots are integers in units of 2^-FRACTION; roots nearer than 2^-CLUSTER of their size count as one.
FRACTION, CLUSTER = 256, 100
_ROUNDS = 3


class Root(NamedTuple):
    """``value`` in units of 2^-FRACTION, and how many roots it stands for."""

    value: int
    count: int


def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``limit``, largest first, by a sieve over windows."""
    small = np.ones(math.isqrt(limit) + 1, bool)
    small[:2] = False
    for p in range(2, math.isqrt(len(small)) + 1):
        if small[p]:
            small[p * p::p] = False
    divisors, found, high = np.flatnonzero(small).tolist(), [], limit
    while len(found) < count:
        low = max(high - 32 * len(divisors), len(small))
        window = np.ones(high - low, bool)
        for p in divisors:
            window[-low % p::p] = False
        found += (low + np.flatnonzero(window)[::-1]).tolist()
        high = low
    return found[:count]


def primes_for(matrix: Matrix) -> list[int]:
    """Primes whose product is more than twice any coefficient of the characteristic polynomial.

    With no negative eigenvalue, the k-th coefficient is at most C(d, k) * (trace / d)^k.
    """
    d = len(matrix)
    mean = sum(matrix[k][k] for k in range(d)) // max(d, 1) + 1
    bound = max((math.comb(d, k) * mean**k for k in range(d + 1)))
    return primes_below(1 << 31, (2 * bound).bit_length() // 30 + 1)


def _inverses(values: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Inverse of each value modulo its prime, by the power p - 2; 0 for 0."""
    out, base, left = np.ones_like(values), values.copy(), primes - 2
    while left.any():
        out = np.where(left & 1, out * base % primes, out)
        base = base * base % primes
        left = left >> 1
    return out


def polynomial_residues(matrix: Matrix, primes: list[int]) -> np.ndarray:
    """Coefficients of det(xI - matrix) modulo each prime, lowest power first: one row per prime."""
    d, q = len(matrix), np.array(primes, np.int64)
    h = np.array([[[a % p for a in row] for row in matrix] for p in primes], np.int64).reshape(len(primes), d, d)
    each, one, two = np.arange(len(primes)), q[:, None], q[:, None, None]
    for k in range(d - 2):
        pivot = k + 1 + np.argmax(h[:, k + 1:, k] != 0, axis=1)
        h[each, pivot], h[each, k + 1] = h[each, k + 1], h[each, pivot]
        h[each, :, pivot], h[each, :, k + 1] = h[each, :, k + 1], h[each, :, pivot]
        factor = h[:, k + 2:, k] * _inverses(h[:, k + 1, k], q)[:, None] % one
        h[:, k + 2:] = (h[:, k + 2:] - factor[:, :, None] * h[:, k + 1, None, :]) % two
        h[:, :, k + 1] = (h[:, :, k + 1] + (factor[:, None, :] * h[:, :, k + 2:] % two).sum(axis=2)) % one
    leading = np.zeros((len(primes), d + 1, d + 1), np.int64)  # polynomials of the leading blocks
    leading[:, 0, 0] = 1
    for k in range(1, d + 1):
        new = -h[:, k - 1, k - 1, None] * leading[:, k - 1] % one
        new[:, 1:] += leading[:, k - 1, :-1]
        below = np.ones(len(primes), np.int64)
        for i in range(1, k):
            below = below * h[:, k - i, k - i - 1] % q
            new -= (below * h[:, k - 1 - i, k - 1] % q)[:, None] * leading[:, k - 1 - i] % one
        leading[:, k] = new % one
    return leading[:, d]


def combine(residues: np.ndarray, primes: list[int]) -> list[int]:
    """The integers of least size with these residues: one per column."""
    product = math.prod(primes)
    weights = [product // p * pow(product // p, -1, p) for p in primes]
    values = [sum(r * w for r, w in zip(column, weights, strict=True)) % product for column in residues.T.tolist()]
    return [v - product if 2 * v > product else v for v in values]


def _shifted(polynomial: list[int], by: int) -> list[int]:
    """Coefficients of p(x + by)."""
    out = polynomial[:]
    for k in range(len(out) - 1):
        for j in range(len(out) - 2, k - 1, -1):
            out[j] += by * out[j + 1]
    return out


def roots_above(polynomial: list[int], point: int) -> int:
    """How many roots are larger than ``point``; exact for a polynomial with real roots only."""
    signs = [c > 0 for c in _shifted(polynomial, point) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(polynomial: list[int], point: int) -> int:
    value = 0
    for c in reversed(polynomial):
        value = value * point + c
    return (value > 0) - (value < 0)


def _refined(polynomial: list[int], low: int, high: int) -> int:
    """The one root in (low, high], rounded up to an integer."""
    above = _sign(polynomial, high)
    while above and high - low > 1:
        middle = (low + high) // 2
        sign = _sign(polynomial, middle)
        if sign == 0:
            return middle
        low, high = (low, middle) if sign == above else (middle, high)
    return high


def largest_roots(polynomial: list[int], count: int) -> list[Root]:
    """The largest positive roots, falling, until ``count`` are covered; zero roots are not given."""
    zeros = next(k for k, c in enumerate(polynomial) if c)
    rest = polynomial[zeros:]
    degree = len(rest) - 1
    if degree == 0:
        return []
    scaled = [c << FRACTION * (degree - k) for k, c in enumerate(rest)]
    top = (-rest[-2] + 1) << FRACTION  # the sum of all roots, and more
    found, open_ = [], [(0, top, degree, 0)]  # (low, high, roots above low, roots above high)
    while open_ and sum(r.count for r in found) < count:
        low, high, above_low, above_high = open_.pop()
        inside = above_low - above_high
        if inside == 0:
            continue
        if inside == 1:
            found.append(Root(_refined(scaled, low, high), 1))
        elif high - low <= max(1, low >> CLUSTER):
            found.append(Root(high, inside))
        else:
            middle = (low + high) // 2
            above = roots_above(scaled, middle)
            open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found


def _factored(matrix: Matrix, root: int) -> tuple[list[np.ndarray], list[tuple[int, list[int]]]]:
    """Rows of the upper factor of (matrix - root), and the pivots and multipliers, all in units of 2^-FRACTION."""
    d = len(matrix)
    rows = [np.array([(a << FRACTION) - (root if i == j else 0) for j, a in enumerate(row)], object)
            for i, row in enumerate(matrix)]
    steps = []
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k][k] = rows[k][k] or 1
        factors = [(rows[i][k] << FRACTION) // rows[k][k] for i in range(k + 1, d)]
        for i, factor in enumerate(factors, k + 1):
            rows[i][k:] -= factor * rows[k][k:] >> FRACTION
        steps.append((pivot, factors))
    return rows, steps


def _solved(rows: list[np.ndarray], steps: list[tuple[int, list[int]]], right: list[int]) -> list[int]:
    right, d = right[:], len(rows)
    for k, (pivot, factors) in enumerate(steps):
        right[k], right[pivot] = right[pivot], right[k]
        for i, factor in enumerate(factors, k + 1):
            right[i] -= factor * right[k] >> FRACTION
    out = [0] * d
    for k in range(d - 1, -1, -1):
        known = sum(a * b for a, b in zip(rows[k][k + 1:].tolist(), out[k + 1:], strict=True))
        out[k] = ((right[k] << 2 * FRACTION) - known) // rows[k][k]
    return out


def _unit(vector: list[int]) -> list[int]:
    """The vector at length 2^FRACTION."""
    length = max(math.isqrt(sum(v * v for v in vector)), 1)
    return [(v << FRACTION) // length for v in vector]


def null_vectors(matrix: Matrix, root: Root, count: int) -> list[list[int]]:
    """``count`` vectors at right angles, of length 2^FRACTION, that the matrix multiplies by the root."""
    rows, steps = _factored(matrix, root.value)
    draw = random.Random(len(matrix))
    vectors = [[draw.getrandbits(FRACTION) - (1 << FRACTION - 1) for _ in matrix] for _ in range(count)]
    for _ in range(_ROUNDS):
        made: list[list[int]] = []
        for vector in vectors:
            vector = _unit(_solved(rows, steps, vector))
            for other in made + made:  # a second time for what rounding left
                along = sum(a * b for a, b in zip(vector, other, strict=True)) >> FRACTION
                vector = [a - (along * b >> FRACTION) for a, b in zip(vector, other, strict=True)]
            made.append(_unit(vector))
        vectors = made
    return vectors


def as_doubles(vector: list[int]) -> list[float]:
    length = math.isqrt(sum(v * v for v in vector))
    return [v / length for v in vector]
