"""Toxicity: non-negative positive-unlabelled learning with numpy.

Confirmed toxic documents are the positives; a sample of all documents, without their labels, is the unlabelled text. With the class prior
p and the logistic loss, the risk p R(positives as 1) + max(0, R(unlabelled as 0) - p R(positives as 0)) is lowered
over the whole bounded sample; where the second part is not positive it counts as 0 and has no gradient.

Features are the distinct words of a text and their first four to eight bytes, by 64-bit hash; those of at least
``LEAST_TEXTS`` positives are weighed, up or down, and a sparsity penalty leaves most at zero. The model is
the short sorted list of hashes whose weight is not zero, so words it never saw cannot fall on one of them by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.llm.labelled import append_column, first_by_hash, remainder, usable_labels
from slotweave.llm.words import LOWER_WORDS, find_words, hash_spans, slices, text_bytes

POSITIVE_ROWS = 3_000
UNLABELLED_ROWS = 5_000
PREFIXES = (4, 5, 6, 7, 8)
LEAST_TEXTS = 3
#: Penalty of a weight's size, in units of the sampling error of the positives' part of the risk.
SPARSITY = 0.15
STEPS = 300
_SALT = {size: np.uint64(0xA24BAED4963EE407 * size % (1 << 64)) for size in PREFIXES}


class Model(NamedTuple):
    """Sorted feature hashes, their weights, and the bias."""

    keys: np.ndarray
    weight: np.ndarray
    bias: float


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every distinct feature of each text, ordered by text number."""
    data, offsets = text_bytes(texts)
    mapped = LOWER_WORDS[data]
    words = find_words(mapped, offsets)
    rows, keys = [words.doc], [hash_spans(mapped, words.start, words.length)]
    for size in PREFIXES:
        long = np.flatnonzero(words.length > size)
        hashes = hash_spans(mapped, words.start[long], np.full(len(long), size))
        rows.append(words.doc[long])
        keys.append(hashes ^ _SALT[size])
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[fresh], key[fresh]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Features that the model has no weight for add nothing; an empty text scores by the bias alone."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    if not len(model.keys):
        return np.full(n, _sigmoid(np.array(model.bias)))
    mapped = LOWER_WORDS[data]
    words = find_words(mapped, offsets)
    found_row, found_at = [], []
    for size in (None, *PREFIXES):
        use = slice(None) if size is None else np.flatnonzero(words.length > size)
        length = words.length[use] if size is None else np.full(len(use), size)
        key = hash_spans(mapped, words.start[use], length)
        if size is not None:
            key = key ^ _SALT[size]
        at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
        hit = np.flatnonzero(model.keys[at] == key)
        found_row.append(words.doc[use][hit])
        found_at.append(at[hit])
    pairs = np.unique(np.concatenate(found_row) * len(model.keys) + np.concatenate(found_at))
    row, at = pairs // len(model.keys), pairs % len(model.keys)
    return _sigmoid(model.bias + np.bincount(row, model.weight[at], n))


def candidates(key: np.ndarray) -> np.ndarray:
    """Features that stand in at least ``LEAST_TEXTS`` positives, given the distinct features of each positive; sorted."""
    keys, within = np.unique(key, return_counts=True)
    return keys[within >= LEAST_TEXTS]


def places(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries of ``key`` are candidates, and where in ``keys`` they stand."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    known = np.flatnonzero(keys[at] == key)
    return known, at[known]


def train(row: np.ndarray, key: np.ndarray, positive: np.ndarray, prior: float, steps: int = STEPS, rate: float = 0.05,
          sparsity: float = SPARSITY) -> Model:
    """``weigh`` for the features of the texts 0 to len(positive) - 1."""
    keys = candidates(key[positive[row]])
    known, column = places(keys, key)
    return weigh(keys, row[known], column, positive, prior, steps, rate, sparsity)


def weigh(keys: np.ndarray, row: np.ndarray, column: np.ndarray, positive: np.ndarray, prior: float, steps: int = STEPS,
          rate: float = 0.05, sparsity: float = SPARSITY) -> Model:
    """Adam with soft thresholds on the non-negative risk; text ``row`` has the candidate ``column``.

    The bias stays at or below the prior: a text without features is no likelier toxic than any text. Without positives,
    or without unlabelled texts, the score is the prior.
    """
    base = float(np.log((prior + 1e-4) / (1 - prior + 1e-4)))
    n_positive, n_rest = int(positive.sum()), int((~positive).sum())
    if not n_positive or not n_rest:
        return Model(np.zeros(0, np.uint64), np.zeros(0), base)
    sparsity *= prior / np.sqrt(n_positive)
    p_share, u_share = np.where(positive, prior / n_positive, 0), np.where(positive, 0, 1 / n_rest)
    weight, bias, mean, square = np.zeros(len(keys)), base, np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(row, weight[column], len(positive))
        as_toxic, slope = _sigmoid(z), -_sigmoid(-z) * p_share
        if np.logaddexp(0, z) @ (u_share - p_share) > 0:
            slope = slope + as_toxic * (u_share - p_share)
        slopes = np.append(np.bincount(column, slope[row], len(keys)), slope.sum())
        mean += 0.1 * (slopes - mean)
        square += 0.001 * (slopes * slopes - square)
        size = rate / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        move = size * mean / (1 - 0.9**step)
        weight -= move[:-1]
        weight = np.sign(weight) * np.maximum(np.abs(weight) - size[:-1] * sparsity, 0)
        bias = min(bias - float(move[-1]), base)
    kept = weight != 0
    return Model(keys[kept], weight[kept], float(bias))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 4, held_out: int = 2,
        positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS, text: str = "text",
        prior: float | None = None) -> Model:
    """Learn from at most ``positive_rows`` confirmed documents and ``unlabelled_rows`` of all, by hash of the id.

    Held-out documents are in neither set; the unlabelled ones stand for all text, confirmed documents among them. Of rows
    with the same id one counts. The class prior is the share of confirmed documents among the labels
    that may be used, unless one is given; without labels it is one half. The executors make the features.
    """
    known = usable_labels(labels, label, parts, held_out)
    if prior is None:
        prior = known.agg(F.avg(F.col("label").cast("double"))).first()[0]
        prior = 0.5 if prior is None else float(prior)
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull() & (remainder("doc_id", parts) != held_out)).distinct()
    confirmed = first_by_hash(known.where("label = 1").select("doc_id"), positive_rows).withColumn("positive", F.lit(True))
    rest = first_by_hash(ids, unlabelled_rows).withColumn("positive", F.lit(False))
    chosen = F.broadcast(confirmed.unionByName(rest))

    first = F.min_by(text, F.struct(F.xxhash64(text), text)).alias(text)
    rows = docs.select("doc_id", text).join(chosen, "doc_id").groupBy("doc_id", "positive").agg(first)

    def lists(found: DataFrame, known: np.ndarray | None) -> pa.Table:
        """Features of each text in order of its id; with ``known`` their places there instead."""
        kind = pa.int64() if known is None else pa.int32()

        def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in slices(batches, text):
                row, key = features(piece.column(text))
                values = key.view(np.int64)
                if known is not None:
                    kept, values = places(known, key)
                    row = row[kept]
                ends = np.searchsorted(row, np.arange(piece.num_rows + 1))
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), made], names=["doc_id", "keys"])

        schema = T.StructType([docs.schema["doc_id"], T.StructField("keys", T.ArrayType(
            T.LongType() if known is None else T.IntegerType()))])
        return found.select("doc_id", text).mapInArrow(sparse, schema).toArrow().sort_by("doc_id").combine_chunks()

    def flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        if not table.num_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        column = table.column("keys").combine_chunks()
        lengths = np.diff(column.offsets.to_numpy())
        return np.repeat(np.arange(len(column)), lengths), column.flatten().to_numpy()

    confirmed_lists = lists(rows.where("positive"), None)
    own, values = flat(confirmed_lists)
    key = values.view(np.uint64)
    keys = candidates(key)
    # The unlabelled texts send the places of candidates only, whose number the confirmed sample bounds.
    rest_lists = lists(rows.where("not positive"), keys)
    kept, column = places(keys, key)
    rest_row, rest_column = flat(rest_lists)
    positive = np.arange(confirmed_lists.num_rows + rest_lists.num_rows) < confirmed_lists.num_rows
    return weigh(keys, np.concatenate([own[kept], rest_row + confirmed_lists.num_rows]),
                 np.concatenate([column, rest_column]).astype(np.int64), positive, prior)


def score(docs: DataFrame, model: Model, name: str = "score", text: str = "text",
          reject_from: float | None = None) -> DataFrame:
    """Append the probability of toxicity, or drop the documents from a bound upwards and append nothing.

    A document without any sign of toxicity, which scores no more than an empty text, is kept whatever the bound; so
    without confirmed documents to learn from, all are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def values(piece: pa.RecordBatch) -> pa.Array:
        return pa.array(scores(shared.value, piece.column(text)), pa.float64())

    without = float(_sigmoid(np.array(model.bias)))
    keep = None if reject_from is None else lambda made: pa.array(
        (made.to_numpy() < reject_from) | (made.to_numpy() <= without))
    return append_column(docs, name, T.DoubleType(), values, keep, text)
