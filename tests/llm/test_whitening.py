"""Whitening against exact sums, a floating-point eigensolver, and matrices whose spectrum is known."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from slotweave.llm import exact_spectrum as S
from slotweave.llm import whitening as W
from slotweave.llm.queries import QUERIES, op13_whitening

from .conftest import FOLDER


def leverrier(matrix):
    """Characteristic polynomial by traces of powers, in fractions."""
    d = len(matrix)
    a = np.array([[Fraction(x) for x in row] for row in matrix], object).reshape(d, d)
    m, out = np.zeros((d, d), object), [Fraction(1)]
    for k in range(1, d + 1):
        m = a @ m + out[-1] * np.eye(d, dtype=int).astype(object)
        out.append(-(a @ m).trace() / k)
    return [int(c) for c in reversed(out)]


def gram(rows):
    return (rows.T.astype(object) @ rows.astype(object)).tolist()


@pytest.mark.parametrize("d, n, size", [(1, 3, 10), (2, 2, 5), (3, 2, 9), (6, 20, 10**9), (9, 30, 3), (12, 4, 10**5)])
def test_polynomial(d, n, size):
    rng = np.random.default_rng(d)
    matrix = gram(rng.integers(-size, size + 1, (n, d)))
    primes = S.primes_for(matrix)
    assert S.combine(S.polynomial_residues(matrix, primes), primes) == leverrier(matrix)
    few = S.primes_below(50, 4)  # small primes make pivots vanish
    assert few == [47, 43, 41, 37]
    assert S.polynomial_residues(matrix, few).tolist() == [[c % p for c in leverrier(matrix)] for p in few]


def test_roots_are_counted_and_found_exactly():
    def product(roots):
        out = [1]
        for r in roots:
            out = [a - r * b for a, b in zip([0, *out], [*out, 0], strict=True)]
        return out

    rng = random.Random(4)
    for _ in range(40):
        roots = sorted((rng.choice([0, 1, 2, 7, 10**12, 10**12 + 1, rng.randint(1, 10**30)]) for _ in range(rng.randint(1, 9))), reverse=True)
        p = product(roots)
        for at in (0, 1, 5, 10**12, 10**30):
            assert S.roots_above(p, at) == sum(r > at for r in roots)
        found = S.largest_roots(p, len(roots))
        assert [(r.value >> S.FRACTION) + (r.value % (1 << S.FRACTION) > 1 << 200) for r in found for _ in range(r.count)] == [r for r in roots if r]


def test_components_of_near_and_equal_eigenvalues():
    # Two blocks with equal spectra, and one that differs in the twelfth digit.
    block = [[5 * 10**12, 10**12], [10**12, 5 * 10**12]]
    other = [[5 * 10**12, 10**12 + 1], [10**12 + 1, 5 * 10**12]]
    matrix = [[0] * 6 for _ in range(6)]
    for k, b in enumerate((block, block, other)):
        for i in range(2):
            matrix[2 * k + i][2 * k:2 * k + 2] = b[i]
    primes = S.primes_for(matrix)
    roots = S.largest_roots(S.combine(S.polynomial_residues(matrix, primes), primes), 6)
    assert [r.count for r in roots] == [1, 2, 2, 1]
    vectors = [S.as_doubles(v) for r in roots for v in S.null_vectors(matrix, r, r.count)]
    assert np.abs(np.array(vectors) @ np.array(vectors).T - np.eye(6)).max() < 1e-15
    assert np.allclose(np.abs(vectors[0]), [0, 0, 0, 0, math.sqrt(.5), math.sqrt(.5)], atol=1e-15)
    for vector, value in zip(vectors, [r.value / 2**S.FRACTION for r in roots for _ in range(r.count)], strict=True):
        assert np.allclose(np.array(matrix, float) @ vector, value * np.array(vector), rtol=0, atol=1e-2)


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for size in (3, 10**5, 1 << 62):
        rows = rng.integers(-size, size, (40, 3), dtype=np.int64)
        assert (W._products(rows) == rows.T.astype(object) @ rows.astype(object)).all()


def check(rows, got):
    """Compare with exact sums in Python integers, and with an eigensolver."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(column) for column in zip(*x, strict=True)]
    assert len(got) == n * min(8, d) and {r.n for r in got} == {n}
    deviations = sorted((str(i), sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True))) for (i, _), v in zip(rows, x, strict=True))
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == deviations
    centred = np.array(x, float) - np.array([float(Fraction(b, n)) for b in s])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    for k in range(min(8, d)):
        own = sorted(((str(r.vec_id), r.whitened, r.explained) for r in got if r.component == k + 1), key=str)
        value = values[-1 - k]
        if own[0][1] is None:
            assert abs(value) < 1e-6 and own[0][2] == 0
            continue
        assert abs(own[0][2] - value / values.sum()) <= 1e-9
        want = np.sort(centred @ vectors[:, -1 - k] / math.sqrt(value))
        mine = np.sort([w for _, w, _ in own])
        assert min(np.abs(mine - want).max(), np.abs(mine + want[::-1]).max()) < 1e-6
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-4


def test_op13(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(rows, QUERIES["op13_whitening"](spark, FOLDER).collect())


SCHEMA = "vec_id long, embedding array<float>, component int, n string, whitened string"


def through(spark, tmp_path, rows):
    spark.createDataFrame([(*r, None, "n", "w") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    return op13_whitening(spark, str(tmp_path)).collect()


def test_odd_rows(spark, tmp_path):
    rng = random.Random(0)
    good = [(k, [rng.gauss(0, 1), rng.gauss(5, 2), 3.0]) for k in range(30)] + [(None, [1.0, 2.0, 3.0]), (3, [0.0, -1.0, 3.0]), (3, [0.0, -1.0, 3.0])]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [float("nan"), 1.0, 1.0]), (93, [float("inf"), 1.0, 1.0]), (94, []), (95, [1.0])]
    as_float = [(i, [float(np.float32(c)) for c in v]) for i, v in good]
    check(as_float, through(spark, tmp_path, good + bad))


@pytest.mark.parametrize("rows, want", [
    ([], 0), ([(1, None)], 0), ([(1, []), (2, [])], 0),
    ([(1, [1.0, 2.0])], 2), ([(1, [1.0, 2.0]), (2, [1.0, 2.0])], 4),
])
def test_nothing_to_whiten(spark, tmp_path, rows, want):
    got = through(spark, tmp_path, rows)
    assert len(got) == want and all(r.whitened is None and r.explained == 0 and r.deviation == 0 for r in got)


def test_large_entries(spark, tmp_path):
    rows = [(k, [float(np.float32(v)) for v in (1e30 * (-1) ** k, k * 1e15, 1.0)]) for k in range(6)]
    got = through(spark, tmp_path, rows)
    assert len(got) == 18 and {r.deviation for r in got} == {None} and got[0].identity_error <= 1e-4
