"""Quality rules under weak supervision.

Every rule looks at one property of a whole text and votes good (1), bad (-1) or abstains (0) in between. A generative model
with a hidden quality, in which each rule has its own probabilities of the three votes on good and on bad texts, is fitted by
expectation-maximisation; a document is judged by its posterior probability of being good, not by passing every rule.

Defects rarely occur together, so without bounds the hidden quality could become one defect. Two bounds say what a bad vote
means: on good texts it is rare (``FALSE_ALARMS``), on bad ones commoner by at least ``LEAST_RATIO``. Everything else is estimated.

The fit needs only how often each pattern of votes occurs. There are at most 3^10 patterns whatever the corpus, so
the counts cover all documents, are summed before the shuffle, and are the one thing the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotweave.llm.textstats import Structure, structure
from slotweave.llm.words import slices

#: A rule's name, the bound up to which it votes good, and that from which it votes bad.
RULES = (
    ("few_words", -50.0, -5.0),
    ("symbols_per_word", 0.02, 0.1),
    ("marks_per_word", 0.02, 0.15),
    ("upper_share", 0.08, 0.3),
    ("repeated_words", 0.05, 0.3),
    ("repeated_lines", 0.1, 0.3),
    ("odd_word_length", 0.8, 1.6),
    ("unlettered_share", 0.03, 0.1),
    ("odd_stops", 0.7, 1.4),
    ("few_distinct_words", -0.6, -0.3),
)
#: Characters a word and stops a word of common prose.
WORD_LENGTH, STOPS = 5.2, 0.12
#: Largest probability of a bad vote on a good text, smallest one on a bad text, and the least ratio of the two.
FALSE_ALARMS, LEAST_CAUGHT, LEAST_RATIO = 0.02, 0.05, 2.0
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(s: Structure) -> np.ndarray:
    """One row per text, one column per rule; larger is worse."""
    words, letters = np.maximum(s.n_words, 1), np.maximum(s.n_upper + s.n_lower, 1)
    return np.stack([
        -s.n_words, s.n_symbols / words, s.n_marks / words, s.n_upper / letters, s.n_repeat_words / words,
        s.n_dup_lines / np.maximum(s.n_lines, 1), np.abs(s.word_chars / words - WORD_LENGTH),
        (s.n_symbols + s.n_marks + s.n_digits) / np.maximum(s.word_chars, 1),
        np.abs(np.log(np.maximum(s.n_stops / words, 0.001) / STOPS)), -s.n_distinct_words / words,
    ], 1)


def votes(s: Structure) -> np.ndarray:
    """Between its two bounds a rule abstains; on texts without words all but the first abstain."""
    values = statistics(s)
    good, bad = np.array([r[1] for r in RULES]), np.array([r[2] for r in RULES])
    out = np.where(values <= good, 1, np.where(values >= bad, -1, 0)).astype(np.int8)
    out[s.n_words == 0, 1:] = 0
    return out


def pattern(ballots: np.ndarray) -> np.ndarray:
    """A row of votes as one number in base three."""
    return (ballots.astype(np.int64) + 1) @ (3 ** np.arange(len(RULES)))


def ballots_of(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(RULES)) % 3 - 1


def _chances(weights: np.ndarray, cast: np.ndarray) -> np.ndarray:
    """Probabilities of bad, none and good by rule; each vote counts once beside those cast."""
    counts = np.tensordot(weights, cast, 1) + 1
    return counts / counts.sum(1, keepdims=True)


def _bound_bad(chances: np.ndarray, low: np.ndarray | float, high: float) -> np.ndarray:
    """The same with the chance of a bad vote within bounds, the others in their proportion."""
    bad = np.clip(chances[:, :1], np.reshape(low, (-1, 1)), high)
    rest = chances[:, 1:] / chances[:, 1:].sum(1, keepdims=True)
    return np.hstack([bad, rest * (1 - bad)])


def fit(ballots: np.ndarray, counts: np.ndarray, steps: int = 200, prior: float = 0.8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior probability of good for each pattern of votes, and by rule the chances of bad, none and good on good and on bad texts.

    The log odds are the prior's plus, for each rule, the log of the ratio of its vote's chances. The share of good texts
    stays within 0.05 to 0.95. The result does not depend on the order of the patterns, but for rounding. No rows give no posteriors.
    """
    n_rules = ballots.shape[1]
    cast = np.stack([ballots == vote for vote in (-1, 0, 1)], 2).astype(float)
    on_good, on_bad = np.tile([0.01, 0.19, 0.8], (n_rules, 1)), np.tile([0.3, 0.3, 0.4], (n_rules, 1))
    share_good, posterior = prior, np.zeros(len(counts))
    for _ in range(steps if len(counts) else 0):
        odds = np.tensordot(cast, np.log(on_good / on_bad), 2) + np.log(share_good / (1 - share_good))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        on_good = _bound_bad(_chances(posterior * counts, cast), 0.0, FALSE_ALARMS)
        on_bad = _bound_bad(_chances((1 - posterior) * counts, cast), np.maximum(LEAST_CAUGHT, LEAST_RATIO * on_good[:, 0]), 1.0)
        share_good = float(np.clip((posterior * counts).sum() / counts.sum(), 0.05, 0.95))
    return posterior, on_good, on_bad


def rule_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the five counts and the vote pattern of every document; null is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            s = structure(piece.column(text))
            made = [pa.array(getattr(s, c), pa.int64()) for c in COUNTS] + [pa.array(pattern(votes(s)), pa.int64())]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *made], names=["doc_id", *COUNTS, "pattern"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, {counts}, pattern long")


def judge(table: DataFrame) -> DataFrame:
    """Append ``posterior`` to a table of patterns; the table is read twice, so it should be a written one."""
    got = table.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").toPandas()
    posterior, _, _ = fit(ballots_of(got["pattern"].to_numpy(np.int64)), got["n"].to_numpy(float))
    spark = table.sparkSession
    known = spark.createDataFrame(
        pa.table({"pattern": pa.array(got["pattern"], pa.int64()), "posterior": pa.array(posterior, pa.float64())}))
    return table.join(F.broadcast(known), "pattern", "left")
