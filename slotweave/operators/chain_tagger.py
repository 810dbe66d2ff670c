"""A tagger that knows which tag follows which: a linear-chain conditional random field.

The token features are those of ``tagger``; weights of steps between tags join them. Each pass computes the likelihood's
gradient by forward and backward sums on the executors. Tasks give their sums as integers of a fixed scale, one row per
feature they met, and Spark adds them; integer sums do not depend on the order, so a run that was broken off and
taken up again ends in the same weights. The driver holds a few vectors of the size that ``buckets`` and the tag set fix
(checked) and takes L-BFGS steps. After every pass the weights are written and, if there are validation rows, scored by
whole spans; the best pass becomes the tagger. Tagging broadcasts the weights and finds the best path of each query,
which never breaks the BIOES rules.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.functions.spans import TAGS
from slotweave.operators import chain_model as M
from slotweave.operators.tagger import BUCKETS, MAX_WEIGHT_BYTES, TEMPLATES, Tagger, with_features

PASSES, REG_PARAM, MEMORY = 30, 1e-5, 6
#: A pass that improves the objective by less than this share of it is the last one.
TOLERANCE = 1e-5
_HALVINGS = 20
_SCHEMA = "kind string, row int, numbers array<double>, settings string"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, by Spark's own file systems."""
    try:
        spark.read.text(path).limit(0).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


class Weights(NamedTuple):
    """One row per feature; then one per tag for the steps from it, one for first and one for last tags."""

    table: np.ndarray

    @property
    def chain(self) -> M.Chain:
        size = self.table.shape[1]
        return M.Chain(self.table[-size - 2:-2], self.table[-2], self.table[-1])

    def scores(self, features: np.ndarray) -> np.ndarray:
        """One row of scores per token, from ``TEMPLATES`` feature numbers each."""
        parts = features.reshape(-1, TEMPLATES)
        out = np.zeros((len(parts), self.table.shape[1]))
        for k in range(TEMPLATES):
            out += self.table[parts[:, k]]
        return out


def _offsets(column: pa.Array, width: int = 1) -> np.ndarray:
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths // width)]).astype(np.int64)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def chain_examples(labelled: DataFrame, tags: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``_features`` and ``ids`` of rows with a tag for each token; null, empty and uneven rows teach nothing.

    An unknown tag is an error.
    """
    names = F.array(*(F.lit(tag) for tag in tags))

    def number(tag: Column) -> Column:
        unknown = F.raise_error(F.concat(F.lit("unknown tag "), F.coalesce(tag, F.lit("NULL"))))
        return F.when(tag.isin(tags), F.array_position(names, tag) - 1).otherwise(unknown).cast("int")

    ids = F.transform("bioes_tags", number)
    even = labelled.where((F.size("tokens") > 0) & (F.size("tokens") == F.size("bioes_tags")))
    return with_features(even.select("tokens", "bioes_tags"), buckets=buckets).select("_features", ids.alias("ids"))


def _add_by_row(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(rows) else order
    if len(first):
        into[ordered[first]] += np.add.reduceat(values[order], first, axis=0)


def _loss_and_gradient(batch: pa.RecordBatch, weights: Weights, rules: M.Rules, gradient: np.ndarray) -> float:
    """Adds a batch's part to the gradient of the negative log-likelihood and returns its part of the loss."""
    features, ids = _flat(batch.column("_features")), _flat(batch.column("ids"))
    offsets, size = _offsets(batch.column("ids")), len(rules.begins)
    kept = M.keeps_rules(ids, offsets, rules)
    token = np.repeat(kept, np.diff(offsets))
    features, ids = features.reshape(-1, TEMPLATES)[token], ids[token]
    offsets = np.concatenate([[0], np.cumsum(np.diff(offsets)[kept])])
    scores = weights.scores(features)
    expected = M.expectation(scores, offsets, weights.chain, rules)
    off = expected.tags.copy()
    off[np.arange(len(ids)), ids] -= 1
    for k in range(TEMPLATES):
        _add_by_row(gradient, features[:, k], off)
    real = M.path_counts(ids, offsets, size)
    gradient[-size - 2:-2] += expected.chain.step - real.step
    gradient[-2] += expected.chain.first - real.first
    gradient[-1] += expected.chain.last - real.last
    return expected.log_total - M.path_scores(scores, ids, offsets, weights.chain)


class Objective:
    """Mean negative log-likelihood of the examples with a squared penalty, and its gradient: one Spark job a call."""

    def __init__(self, examples: DataFrame, tags: list[str], buckets: int, reg_param: float):
        self.examples, self.tags, self.reg_param = examples, tags, reg_param
        self.rows = TEMPLATES * buckets + len(tags) + 2
        if self.rows * len(tags) * 8 > MAX_WEIGHT_BYTES:
            raise ValueError(f"weights of {self.rows * len(tags) * 8} bytes are too large to broadcast")
        self.rules = M.bioes_rules(tags)
        self.queries, self.tokens, self.malformed = self._sizes()
        # A token's part of the loss stays below 2^10 for any weights that the penalty allows.
        self.scale = 2.0 ** (52 - max(self.tokens, 1).bit_length())

    def _sizes(self) -> tuple[int, int, int]:
        """Rows and tokens to learn from, and rows left out because their tags break the BIOES rules."""
        rules = self.rules

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                offsets = _offsets(batch.column("ids"))
                kept = M.keeps_rules(_flat(batch.column("ids")), offsets, rules)
                yield pa.RecordBatch.from_pylist([
                    {"rows": int(kept.sum()), "tokens": int(np.diff(offsets)[kept].sum()), "malformed": int((~kept).sum())}])

        got = self.examples.select("ids").mapInArrow(run, "rows long, tokens long, malformed long").agg(
            F.sum("rows"), F.sum("tokens"), F.sum("malformed")).first()
        return tuple(n or 0 for n in got)

    def __call__(self, table: np.ndarray) -> tuple[float, np.ndarray]:
        spark, rules, rows, size, scale = self.examples.sparkSession, self.rules, self.rows, len(self.tags), self.scale
        shared = spark.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, sums, loss = Weights(shared.value), np.zeros((rows + 1, size)), 0.0
            for batch in batches:
                loss += _loss_and_gradient(batch, weights, rules, sums[:-1])
            sums[-1, 0] = loss
            met = np.flatnonzero(sums.any(axis=1))
            columns = np.rint(sums[met] * scale).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(met, pa.int32()), *(pa.array(columns[:, k]) for k in range(size))],
                names=["row", *(f"s{k}" for k in range(size))])

        parts = self.examples.mapInArrow(run, "row int, " + ", ".join(f"s{k} long" for k in range(size)))
        summed = parts.groupBy("row").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(size))).toArrow()
        shared.destroy()
        total = np.zeros((rows + 1, size))
        total[summed.column("row").to_numpy()] = np.stack(
            [summed.column(f"s{k}").to_numpy() for k in range(size)], axis=1)
        total /= scale * max(self.tokens, 1)
        return (float(total[-1, 0] + 0.5 * self.reg_param * (table * table).sum()),
                total[:-1] + self.reg_param * table)


class Pass(NamedTuple):
    """State after a pass: all that the next one needs, with that of the passes before."""

    number: int
    objective: float
    f1: float  # of whole spans of the validation rows; NaN without
    weights: np.ndarray
    gradient: np.ndarray


def _direction(passes: list[Pass]) -> np.ndarray:
    """L-BFGS direction from the latest passes, latest last."""
    last, pairs = passes[-1], []
    for a, b in zip(passes, passes[1:]):
        s, y = b.weights - a.weights, b.gradient - a.gradient
        if (s * y).sum() > 1e-12 * (y * y).sum():
            pairs.append((s, y, 1.0 / (s * y).sum()))
    out, kept = last.gradient.copy(), []
    for s, y, r in reversed(pairs):
        kept.append(r * (s * out).sum())
        out -= kept[-1] * y
    if pairs:
        s, y, r = pairs[-1]
        out *= 1.0 / (r * (y * y).sum())
    for (s, y, r), a in zip(pairs, reversed(kept), strict=True):
        out += (a - r * (y * out).sum()) * s
    return -out


def _stepped(objective: Objective, passes: list[Pass]) -> tuple[np.ndarray, float, np.ndarray] | None:
    """Weights, objective and gradient of the next pass; None where no step improves."""
    last, direction = passes[-1], _direction(passes)
    slope = float((last.gradient * direction).sum())
    if slope >= 0:
        return None
    # The first step has no curvature to go by: it moves the weights by one in all.
    size = 1.0 if len(passes) > 1 else 1.0 / max(np.sqrt((last.gradient**2).sum()), 1e-12)
    for _ in range(_HALVINGS):
        weights = last.weights + size * direction
        value, gradient = objective(weights)
        if value <= last.objective + 1e-4 * size * slope:
            return weights, value, gradient
        size /= 2
    return None


def span_f1(examples: DataFrame, weights: np.ndarray, tags: list[str]) -> float:
    """F1 of whole spans of best paths against the examples' own tags; 0 where there are none."""
    shared, rules = examples.sparkSession.sparkContext.broadcast(weights), M.bioes_rules(tags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(shared.value)
        for batch in batches:
            offsets = _offsets(batch.column("ids"))
            found = M.best_paths(weights.scores(_flat(batch.column("_features"))), offsets, weights.chain, rules)
            counts = M.span_counts(_flat(batch.column("ids")), found, offsets, tags)
            yield pa.RecordBatch.from_pylist([dict(zip(("hits", "found", "true"), counts, strict=True))])

    hits, found, true = (n or 0 for n in examples.mapInArrow(run, "hits long, found long, true long").agg(
        F.sum("hits"), F.sum("found"), F.sum("true")).first())
    shared.destroy()
    return 2 * hits / (found + true) if found + true else 0.0


def _frame(spark: SparkSession, tables: list[pa.Table]) -> DataFrame:
    """Tables of ``_SCHEMA``, of which some may be empty, in one piece: an empty batch would end the transfer."""
    return spark.createDataFrame(pa.concat_tables(tables).combine_chunks(), _SCHEMA)


def _sparse(kind: str, table: np.ndarray, settings: str | None = None) -> pa.Table:
    """Rows that are not all zero, as a table of ``_SCHEMA``."""
    rows = np.flatnonzero(table.any(axis=1))
    return pa.table({
        "kind": pa.array([kind] * len(rows), pa.string()), "row": pa.array(rows, pa.int32()),
        "numbers": pa.array(list(table[rows]), pa.list_(pa.float64())),
        "settings": pa.array([settings] * len(rows), pa.string()),
    })


def _dense(table: pa.Table, kind: str, shape: tuple[int, int]) -> np.ndarray:
    part = table.filter(pa.compute.equal(table.column("kind"), kind))
    out = np.zeros(shape)
    if part.num_rows:
        out[part.column("row").to_numpy()] = np.array(part.column("numbers").to_pylist())
    return out


class PassStore:
    """One Parquet file per pass: it is there as a whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str, settings: dict, shape: tuple[int, int]):
        self.spark, self.folder, self.shape = spark, folder, shape
        self.settings = json.dumps(settings, sort_keys=True)

    def write(self, state: Pass) -> None:
        info = pa.table({
            "kind": pa.array(["info"]), "row": pa.array([0], pa.int32()),
            "numbers": pa.array([[state.objective, state.f1]], pa.list_(pa.float64())), "settings": pa.array([self.settings]),
        })
        tables = [info, _sparse("weights", state.weights), _sparse("gradient", state.gradient)]
        _frame(self.spark, tables).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/pass={state.number}")

    def _rows(self) -> DataFrame | None:
        if not exists(self.spark, self.folder):
            return None
        return self.spark.read.schema(f"{_SCHEMA}, pass int").parquet(self.folder)

    def numbers(self) -> list[int]:
        """Passes that are there; passes of other data or settings are an error."""
        rows = self._rows()
        found = rows.where("kind = 'info'").select("pass", "settings").collect() if rows else []
        if any(r["settings"] != self.settings for r in found):
            raise ValueError(f"{self.folder} holds passes of another training run")
        return sorted(r["pass"] for r in found)

    def read(self, number: int) -> Pass:
        table = self._rows().where(F.col("pass") == number).select("kind", "row", "numbers").toArrow()
        objective, f1 = table.filter(pa.compute.equal(table.column("kind"), "info")).column("numbers")[0].as_py()
        return Pass(number, objective, f1, _dense(table, "weights", self.shape), _dense(table, "gradient", self.shape))

    def history(self) -> list[tuple[int, float, float]]:
        """(pass, objective, F1) of all passes."""
        found = self._rows().where("kind = 'info'").select("pass", "numbers").collect()
        return sorted((r["pass"], *r["numbers"]) for r in found)


class ChainTagger(Tagger):
    """Fitted weights with their tag vocabulary; ``history`` has (pass, objective, F1 of validation spans)."""

    def __init__(self, weights: np.ndarray, tags: list[str], buckets: int, history: list[tuple[int, float, float]] = ()):
        self.weights, self.tags, self.buckets, self.history = Weights(weights), tags, buckets, list(history)

    def save(self, path: str, mode: str = "error") -> None:
        """Write weights and vocabulary as one Parquet table below ``path``; ``mode`` is "error" or "overwrite"."""
        settings = json.dumps({"tags": self.tags, "buckets": self.buckets, "history": [list(h) for h in self.history]})
        head = pa.table({"kind": pa.array(["info"]), "row": pa.array([0], pa.int32()),
                         "numbers": pa.array([[]], pa.list_(pa.float64())), "settings": pa.array([settings])})
        rows = _frame(SparkSession.active(), [head, _sparse("weights", self.weights.table)])
        rows.write.mode(mode).parquet(f"{path}/chain")

    @staticmethod
    def load(path: str) -> ChainTagger:
        table = SparkSession.active().read.schema(_SCHEMA).parquet(f"{path}/chain").toArrow()
        head = json.loads(next(s for s in table.column("settings").to_pylist() if s))
        shape = TEMPLATES * head["buckets"] + len(head["tags"]) + 2, len(head["tags"])
        return ChainTagger(_dense(table, "weights", shape), head["tags"], head["buckets"], [tuple(h) for h in head["history"]])

    def _scorer(self, spark: SparkSession):
        """Arrow function from flat feature numbers to the tag ids of the best path."""
        shared, rules = spark.sparkContext.broadcast(self.weights.table), M.bioes_rules(self.tags)

        @F.arrow_udf("array<int>")
        def best(features: pa.Array) -> pa.Array:
            weights, offsets = Weights(shared.value), _offsets(features, TEMPLATES)
            ids = M.best_paths(weights.scores(_flat(features)), offsets, weights.chain, rules)
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids), mask=features.is_null())

        return best


def load_tagger(path: str) -> Tagger:
    """The saved tagger below ``path``, of either kind."""
    return ChainTagger.load(path) if exists(SparkSession.active(), f"{path}/chain") else Tagger.load(path)


def train_chain(
    labelled: DataFrame, folder: str, validation: DataFrame | None = None, buckets: int = BUCKETS, passes: int = PASSES,
    reg_param: float = REG_PARAM, tolerance: float = TOLERANCE,
) -> ChainTagger:
    """Fit a chain tagger on the ``tokens`` and ``bioes_tags`` of a labelled table.

    ``folder`` keeps the examples and each pass; a folder of a run that was broken off is taken up where it ended. With
    ``validation`` rows the pass with the largest F1 of their spans is kept, the later one of equals; else the last one.
    A table without a token to learn from is an error.
    """
    spark = labelled.sparkSession
    tags = sorted(TAGS)  # a closed set of 13
    sides = {}
    for name, rows in (("training", labelled), ("validation", validation)):
        if rows is not None:
            if not exists(spark, f"{folder}/{name}/_SUCCESS"):
                chain_examples(rows, tags, buckets).write.mode("overwrite").parquet(f"{folder}/{name}")
            sides[name] = spark.read.schema("_features array<int>, ids array<int>").parquet(f"{folder}/{name}")
    objective = Objective(sides["training"], tags, buckets, reg_param)
    if objective.tokens == 0:
        raise ValueError("no labelled token to learn from")
    shape = objective.rows, len(tags)
    store = PassStore(spark, f"{folder}/passes", {
        "tags": tags, "buckets": buckets, "reg_param": reg_param, "rows": objective.queries, "tokens": objective.tokens,
    }, shape)

    def measured(number: int, weights: np.ndarray, value: float, gradient: np.ndarray) -> Pass:
        f1 = span_f1(sides["validation"], weights, tags) if "validation" in sides else float("nan")
        state = Pass(number, value, f1, weights, gradient)
        store.write(state)
        return state

    numbers = store.numbers()
    recent = [store.read(k) for k in numbers[-MEMORY - 1:]]
    if not recent:
        weights = np.zeros(shape)
        recent = [measured(0, weights, *objective(weights))]
    while recent[-1].number < passes:
        gained = len(recent) < 2 or recent[-2].objective - recent[-1].objective > tolerance * abs(recent[-1].objective)
        following = _stepped(objective, recent) if gained else None
        if following is None:
            break
        recent = [*recent[-MEMORY:], measured(recent[-1].number + 1, *following)]
    history = store.history()
    best = history[-1][0]
    if "validation" in sides:
        best = max(history, key=lambda h: (h[2], h[0]))[0]
    chosen = next((p for p in recent if p.number == best), None) or store.read(best)
    return ChainTagger(chosen.weights, tags, buckets, history)
