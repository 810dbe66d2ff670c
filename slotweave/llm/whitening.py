"""Whitening of embeddings by the exact spectrum of their integer scatter.

Entries become integers. Each task sums the products of its rows exactly: entries are cut into digits of 18 bits, whose
products add up in floating-point matrix products without rounding. Spark adds the tasks' sums digit by digit, so what
reaches the driver has the size of one matrix, whatever the number of rows. The characteristic polynomial is computed
modulo many primes, which Spark spreads over the executors; roots and components follow from it (``exact_spectrum``).

Rows whose vector is null, or holds null or non-finite entries, are left out. So are vectors that lack or have entries
beyond the commonest length (of equally common ones the longest), as entries must stand in one space. Repeated rows and
ids, and null ids, are rows like all others; other columns are not used. Without rows, or with empty vectors, the result
is empty. Where fewer than the wanted components have a positive eigenvalue (one row, constant or dependent entries), the
rest is given with ``explained`` 0 and ``whitened`` null. Of equal eigenvalues any components at right angles are given.
Entries beyond 2^62 once scaled count as that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.llm import exact_spectrum as S

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
_LIMIT = float(1 << 62)
_DIGIT, _ROWS, _SUM_DIGIT = 18, 1 << 15, 40
_DECIMAL = 10**38
PRIMES_A_TASK = 16


class Whitening(NamedTuple):
    """What a fit knows: number of rows, sums of the integers, trace and roots of n^2 times their covariance."""

    dimensions: int
    rows: int
    sums: list[int]
    trace: int
    roots: list[float]  # falling; 0 where there is none
    components: np.ndarray  # one unit row per positive root


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector has the commonest length and finite entries only."""
    vector = F.col(column)
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(math.inf)))
    rows = vectors.where(vector.isNotNull() & finite)
    common = rows.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("size")).limit(1).collect()
    return rows.where(F.size(vector) == (common[0]["size"] if common else 0))


def _integers(column: pa.Array) -> np.ndarray:
    """floor(SCALE * c) of each entry, one row per vector; OFFSET is left out, which no centred value notices."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * flat)
    return np.clip(scaled, -_LIMIT, _LIMIT).astype(np.int64).reshape(len(column), -1)


def _digits(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Signed digits of ``bits`` bits, lowest first, as many as the largest value needs."""
    out, half = [], 1 << bits - 1
    while values.any() or not out:
        low = (values + half) % (1 << bits) - half
        out.append(low)
        values = (values - low) >> bits
    return out


def _products(rows: np.ndarray) -> np.ndarray:
    """Exact sums over all rows of the products of their entries, as Python integers."""
    total = np.zeros((rows.shape[1],) * 2, object)
    for start in range(0, len(rows), _ROWS):
        digits = [x.astype(np.float64) for x in _digits(rows[start:start + _ROWS], _DIGIT)]
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                total += (a.T @ b).astype(np.int64).astype(object) << _DIGIT * (i + j)
    return total


def scatter(rows: DataFrame, dimensions: int, column: str = "embedding") -> S.Matrix:
    """Sums of products of all pairs of entries, the last entry being 1 in every row."""
    d = dimensions + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            if batch.num_rows:
                values = _integers(batch.column(column))
                total += _products(np.hstack([values, np.ones((len(values), 1), np.int64)]))
        cells = np.array([total[i, j] for i in range(d) for j in range(i, d)], object)
        for digit, part in enumerate(_digits(cells, _SUM_DIGIT)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(part)), pa.int32()), pa.array(np.full(len(part), digit), pa.int32()),
                 pa.array(part.astype(np.int64))], names=["cell", "digit", "value"])

    sums = rows.select(column).mapInArrow(run, "cell int, digit int, value long").groupBy("cell", "digit").agg(
        F.sum("value").alias("value")).collect()  # one row per digit of a cell of the matrix
    cells = [0] * (d * (d + 1) // 2)
    for r in sums:
        cells[r["cell"]] += r["value"] << _SUM_DIGIT * r["digit"]
    out, at = [[0] * d for _ in range(d)], iter(cells)
    for i in range(d):
        for j in range(i, d):
            out[i][j] = out[j][i] = next(at)
    return out


def characteristic_polynomial(rows: DataFrame, matrix: S.Matrix) -> list[int]:
    """Integer coefficients of det(xI - matrix), lowest power first; the primes are spread over the executors."""
    spark, primes = rows.sparkSession, S.primes_for(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("prime").to_pylist()
            for start in range(0, len(own), PRIMES_A_TASK):
                some = own[start:start + PRIMES_A_TASK]
                found = S.polynomial_residues(matrix, some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["prime", "residues"])

    tasks = -(-len(primes) // PRIMES_A_TASK)
    table = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
    got = {r["prime"]: r["residues"] for r in table.mapInArrow(run, "prime long, residues array<long>").collect()}
    return S.combine(np.array([got[p] for p in primes], np.int64), primes)


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``usable`` rows; None without rows or entries."""
    first = rows.select(F.size(column).alias("size")).limit(1).collect()
    d = first[0]["size"] if first else 0
    if d == 0:
        return None
    sums = scatter(rows, d, column)
    n, s = sums[d][d], sums[d][:d]
    matrix = [[n * sums[i][j] - s[i] * s[j] for j in range(d)] for i in range(d)]
    wanted = min(components, d)
    trace, roots, vectors = sum(matrix[k][k] for k in range(d)), [], []
    for root in S.largest_roots(characteristic_polynomial(rows, matrix), wanted):
        count = min(root.count, wanted - len(vectors))
        vectors += [S.as_doubles(v) for v in S.null_vectors(matrix, root, count)]
        roots += [root.value / (1 << S.FRACTION)] * count
    return Whitening(d, n, s, trace, roots + [0.0] * (wanted - len(roots)), np.array(vectors).reshape(-1, d))


def _centred(values: np.ndarray, model: Whitening) -> np.ndarray:
    """n times the entries less their sums, exact; Python integers where 64 bits would not hold them."""
    largest = model.rows * int(np.abs(values).max(initial=0)) + max(map(abs, model.sums), default=0)
    if largest < 1 << 62:
        return model.rows * values - np.array(model.sums, np.int64)
    return model.rows * values.astype(object) - np.array(model.sums, object)


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    """n * (x - S/n) along each component, over the square root of n^2 times the eigenvalue."""
    along = centred.astype(np.float64) @ model.components.T
    return along / np.sqrt(np.array(model.roots[:len(model.components)]))


def _squares(centred: np.ndarray) -> list[Decimal | None]:
    largest = int(abs(centred).max(initial=0))
    if largest * largest * max(centred.shape[1], 1) >= 1 << 63:
        centred = centred.astype(object)
    totals = (centred * centred).sum(axis=1).tolist()
    return [Decimal(v) if v < _DECIMAL else None for v in totals]


def identity_error(rows: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """The largest absolute entry of (covariance of the whitened rows - identity); 0 without components."""
    k = len(model.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            if batch.num_rows:
                values = _whitened(_centred(_integers(batch.column(column)), model), model)
                values = np.hstack([values, np.ones((len(values), 1))])
                total += values.T @ values
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["cell", "value"])

    sums = rows.select(column).mapInArrow(run, "cell int, value double").groupBy("cell").agg(
        F.sum("value").alias("value")).collect()
    total = np.zeros((k + 1) ** 2)
    for r in sums:
        total[r["cell"]] = r["value"]
    total = total.reshape(k + 1, k + 1) / model.rows
    return float(np.abs(total[:k, :k] - np.outer(total[k, :k], total[k, :k]) - np.eye(k)).max(initial=0.0))


def whiten(rows: DataFrame, model: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per row and component: ``key``, component, deviation decimal(38, 0), whitened and explained.

    ``deviation`` is the sum over dimensions of (n * x - S)^2, null where it has more than 38 digits.
    """
    wanted = len(model.roots)
    found = len(model.components)
    explained = np.array([r / model.trace if model.trace else 0.0 for r in model.roots])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            centred = _centred(_integers(batch.column(column)), model)
            values = np.full((batch.num_rows, wanted), np.nan)
            values[:, :found] = _whitened(centred, model)
            missing = np.zeros(values.shape, bool)
            missing[:, found:] = True
            repeated = pa.array(np.repeat(np.arange(batch.num_rows), wanted))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(repeated), pa.array(np.tile(np.arange(1, wanted + 1), batch.num_rows), pa.int32()),
                 pa.array(_squares(centred), pa.decimal128(38, 0)).take(repeated),
                 pa.array(values.ravel(), mask=missing.ravel()), pa.array(np.tile(explained, batch.num_rows))],
                names=[key, "component", "deviation", "whitened", "explained"])

    schema = T.StructType([rows.schema[key], T.StructField("component", T.IntegerType()),
                           T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType())])
    return rows.select(key, column).mapInArrow(run, schema)
