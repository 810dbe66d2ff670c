"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: one feature per distinct hashed word, one indicator for the band of each structure
statistic and one for each piece of metadata. The score is

    sigmoid(bias + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)),

all pairwise interactions in time linear in the number of features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.llm.labelled import append_column, first_by_hash, usable_labels
from slotweave.llm.textstats import structure
from slotweave.llm.words import LOWER_WORDS, find_words, hash_spans, mix, slices, text_bytes

WORD_BITS = 15
BANDS = 32
RANK = 8
SAMPLE_ROWS = 12_000
_STATS = 12


class Features(NamedTuple):
    """Sparse rows: feature ``column[k]`` of text ``row[k]`` has the value ``value[k]``; ordered by row."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    n_rows: int


class Machine(NamedTuple):
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    metadata: tuple[str, ...]


def n_features(metadata: Sequence[str]) -> int:
    return (1 << WORD_BITS) + BANDS * (_STATS + len(metadata))


def _bands(texts: pa.Array) -> list[np.ndarray]:
    """The band, 0 to 31, of each structure statistic; shares are cut in even steps, sizes by powers of the root of two."""
    s = structure(texts)
    words, size = np.maximum(s.n_words, 1), np.maximum(s.n_bytes, 1)
    letters, lines = np.maximum(s.n_upper + s.n_lower, 1), np.maximum(s.n_lines, 1)
    shares = [
        s.n_symbols / words, s.n_marks / words, s.n_upper / letters, s.n_digits / size, s.n_stops / words,
        s.n_dup_lines / lines, s.n_repeat_words / words, s.n_distinct_words / words, s.word_chars / words / 20,
    ]
    sizes = [s.n_words, s.n_bytes, s.n_lines]
    return (
        [np.minimum(x * (BANDS - 1), BANDS - 1).astype(np.int64) for x in shares]
        + [np.minimum(2 * np.log2(1 + x), BANDS - 1).astype(np.int64) for x in sizes]
    )


def _metadata_band(column: pa.Array) -> np.ndarray:
    """Numbers by size, other values by hash; null is a band of its own."""
    if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
        values = column.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
        bands = np.minimum(2 * np.log2(1 + np.abs(np.nan_to_num(values))), BANDS - 2).astype(np.int64)
        return np.where(np.isnan(values), BANDS - 1, bands)
    data, offsets = text_bytes(column.cast(pa.string()))
    bands = (hash_spans(data, offsets[:-1], offsets[1:] - offsets[:-1]) % np.uint64(BANDS - 1)).astype(np.int64)
    return np.where(column.is_null().to_numpy(zero_copy_only=False), BANDS - 1, bands)


def features(piece: pa.RecordBatch, text: str, metadata: Sequence[str]) -> Features:
    """Words share the length one among them (value 1 / root of their number); each band counts one half."""
    texts = piece.column(text)
    n, base = len(texts), 1 << WORD_BITS
    data, offsets = text_bytes(texts)
    mapped = LOWER_WORDS[data]
    words = find_words(mapped, offsets)
    buckets = mix(hash_spans(mapped, words.start, words.length)) >> np.uint64(64 - WORD_BITS)
    keys = np.unique((words.doc.astype(np.uint64) << np.uint64(WORD_BITS)) | buckets)
    row, column = (keys >> np.uint64(WORD_BITS)).astype(np.int64), (keys & np.uint64(base - 1)).astype(np.int64)
    value = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))[row]
    bands = _bands(texts) + [_metadata_band(piece.column(c)) for c in metadata]
    for k, band in enumerate(bands):
        row = np.concatenate([row, np.arange(n)])
        column = np.concatenate([column, base + BANDS * k + band])
    value = np.concatenate([value, np.full(n * len(bands), 0.5)])
    order = np.argsort(row, kind="stable")
    return Features(row[order], column[order], value[order], n)


def logits(model: Machine, x: Features) -> np.ndarray:
    """Sum-of-squares identity; every text has features, so no row is empty."""
    linear = np.bincount(x.row, model.weight[x.column] * x.value, x.n_rows)
    first = np.flatnonzero(np.diff(x.row, prepend=-1))
    scaled = model.factor[x.column] * x.value[:, None]
    sums, squares = np.add.reduceat(scaled, first), np.add.reduceat(scaled * scaled, first)
    return model.bias + linear + 0.5 * (sums * sums - squares).sum(1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _take(x: Features, starts: np.ndarray, rows: np.ndarray) -> Features:
    lengths = starts[rows + 1] - starts[rows]
    at = np.repeat(starts[rows] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    return Features(np.repeat(np.arange(len(rows)), lengths), x.column[at], x.value[at], len(rows))


def train(x: Features, labels: np.ndarray, metadata: Sequence[str], epochs: int = 8, rate: float = 0.1,
          decay: float = 1e-5, batch: int = 128, seed: int = 8, least_steps: int = 300) -> Machine:
    """Adagrad on the logistic loss: ``epochs`` passes, or as many as make ``least_steps`` steps.

    Without rows the score is 0.5; with labels of one kind it is near that kind.
    """
    size, rng = n_features(metadata), np.random.default_rng(seed)
    weight, factor = np.zeros(size), rng.normal(0, 0.01, (size, RANK))
    weight_sum, factor_sum = np.full(size, 1e-6), np.full((size, RANK), 1e-6)
    positive = float(labels.mean()) if len(labels) else 0.5
    bias = float(np.log((positive + 1e-3) / (1 - positive + 1e-3)))
    starts = np.searchsorted(x.row, np.arange(x.n_rows + 1))
    passes = max(epochs, -(-least_steps * batch // max(x.n_rows, 1)))
    for _ in range(passes if len(labels) else 0):
        order = rng.permutation(x.n_rows)
        for at in range(0, x.n_rows, batch):
            rows = order[at:at + batch]
            part = _take(x, starts, rows)
            model = Machine(bias, weight, factor, tuple(metadata))
            miss = (_sigmoid(logits(model, part)) - labels[rows]) / len(rows)
            used, column = np.unique(part.column, return_inverse=True)
            scaled = factor[part.column] * part.value[:, None]
            sums = np.add.reduceat(scaled, np.flatnonzero(np.diff(part.row, prepend=-1)))
            slope = (miss[part.row] * part.value)[:, None] * (sums[part.row] - scaled)
            by_weight = np.bincount(column, miss[part.row] * part.value) + decay * weight[used]
            by_factor = np.stack([np.bincount(column, slope[:, f]) for f in range(RANK)], 1) + decay * factor[used]
            weight_sum[used] += by_weight**2
            factor_sum[used] += by_factor**2
            weight[used] -= rate * by_weight / np.sqrt(weight_sum[used])
            factor[used] -= 0.3 * rate * by_factor / np.sqrt(factor_sum[used])
            bias -= rate * float(miss.sum())
    return Machine(bias, weight.astype(np.float32), factor.astype(np.float32), tuple(metadata))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: Sequence[str] = (),
        parts: int = 3, held_out: int = 1, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> Machine:
    """Train on at most ``sample_rows`` labelled documents (the smallest hashes of the id) outside the held-out part.

    Features are made by the executors; the driver gets the sparse rows of that bounded sample alone.
    Labels without a document, without an id and without a value are passed over.
    """
    sample = F.broadcast(first_by_hash(usable_labels(labels, label, parts, held_out), sample_rows))
    rows = docs.select("doc_id", text, *metadata).join(sample, "doc_id").select("label", text, *metadata)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            x = features(piece, text, metadata)
            ends = np.searchsorted(x.row, np.arange(x.n_rows + 1))
            yield pa.RecordBatch.from_arrays([
                piece.column("label"),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.column, pa.int32())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.value, pa.float32())),
            ], names=["label", "column", "value"])

    got = rows.mapInArrow(sparse, "label int, column array<int>, value array<float>").toArrow().combine_chunks()
    if not got.num_rows:
        return train(Features(*(np.zeros(0, np.int64),) * 2, np.zeros(0), 0), np.zeros(0), metadata)
    columns, values = (got.column(c).combine_chunks() for c in ("column", "value"))
    lengths = np.diff(columns.offsets.to_numpy())
    x = Features(np.repeat(np.arange(got.num_rows), lengths), columns.values.to_numpy().astype(np.int64),
                 values.values.to_numpy().astype(np.float64), got.num_rows)
    return train(*_in_fixed_order(x, lengths, got.column("label").to_numpy()), metadata)


def _row_keys(x: Features, lengths: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.add.reduceat(mix(x.column.astype(np.uint64)), starts)


def _in_fixed_order(x: Features, lengths: np.ndarray, labels: np.ndarray) -> tuple[Features, np.ndarray]:
    """Rows by their content, so that the model does not hang on the order in which tasks end."""
    order = np.lexsort((labels, _row_keys(x, lengths)))
    return _take(x, np.concatenate([[0], np.cumsum(lengths)]), order), labels[order].astype(np.float64)


def score(docs: DataFrame, model: Machine, name: str = "score", text: str = "text",
          reject_below: float | None = None) -> DataFrame:
    """Append the probability of good quality, or drop the documents below a bound and append nothing.

    Null and empty texts have the features of an empty text, and so a score like any other.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def values(piece: pa.RecordBatch) -> pa.Array:
        return pa.array(_sigmoid(logits(shared.value, features(piece, text, shared.value.metadata))), pa.float64())

    keep = None if reject_below is None else lambda made: pa.array(made.to_numpy() >= reject_below)
    return append_column(docs, name, T.DoubleType(), values, keep, text)
