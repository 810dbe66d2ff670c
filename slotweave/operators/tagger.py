"""A token tagger learned from labelled queries: hashed context features, multinomial regression.

Features are built on the executors by built-in expressions. Training explodes them into one
row per token and fits an ML pipeline, whose gradient sums are the only data that moves. Tagging
keeps queries whole: the weights are broadcast (their size is fixed by ``buckets`` and the tag
set, and checked) and each Arrow batch is scored in place, so tagging needs neither a shuffle
nor row ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.functions.text import clean_text, split_line, token_line
from slotweave.operators.fence import fence
from slotweave.operators.training_data import tag_vocabulary

BUCKETS = 1 << 12
HASHED_SIZE = 1 << 16
MAX_WEIGHT_BYTES = 512 << 20
_START, _END = "\x1fstart", "\x1fend"
_SCORE_ROWS = 1 << 16


def _shape(token: Column) -> Column:
    """``Xx``, ``xd``, ``d`` ..: character classes of a token, runs written once."""
    upper = F.regexp_replace(token, r"\p{Lu}+", "X")
    return F.regexp_replace(F.regexp_replace(upper, r"\p{Ll}+", "x"), r"\p{Nd}+", "d")


def _features(tokens: Column, lowered: Column, position: Column) -> list[Column]:
    """Feature texts of one token, one per template."""
    word = F.get(lowered, position)
    before = F.coalesce(F.get(lowered, position - 1), F.lit(_START))
    after = F.coalesce(F.get(lowered, position + 1), F.lit(_END))
    return [
        word,
        F.substring(word, 1, 3),
        F.right(word, F.lit(3)),
        _shape(F.get(tokens, position)),
        before,
        after,
        F.concat_ws(" ", before, word),
        F.concat_ws(" ", word, after),
        F.concat_ws(" ", F.least(position, F.lit(4)), F.least(F.size(tokens) - position, F.lit(4))),
    ]


TEMPLATES = 9


def feature_numbers(tokens: Column, lowered: Column, buckets: int) -> Column:
    """Feature numbers of all tokens in one flat array, ``TEMPLATES`` per token.

    Template k owns the numbers from ``k * buckets`` on.
    """

    def of_token(_token: Column, position: Column) -> Column:
        texts = _features(tokens, lowered, position)
        return F.array(*(
            (F.pmod(F.xxhash64(F.lit(k), text), F.lit(buckets)) + k * buckets).cast("int")
            for k, text in enumerate(texts)
        ))

    return F.flatten(F.transform(lowered, of_token))


def with_features(df: DataFrame, tokens: str = "tokens", buckets: int = BUCKETS) -> DataFrame:
    """Add the flat feature array as ``_features``."""
    lowered = df.select("*", F.transform(F.col(tokens), F.lower).alias("_lowered"))
    numbers = feature_numbers(F.col(tokens), F.col("_lowered"), buckets)
    return lowered.select(*df.columns, numbers.alias("_features"))


def token_examples(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per token: its ``tag`` and its feature numbers ``terms``."""
    rows = with_features(df, buckets=buckets).select(F.posexplode("bioes_tags").alias("pos", "tag"), "_features")
    return rows.select("tag", F.slice("_features", F.col("pos") * TEMPLATES + 1, F.lit(TEMPLATES)).alias("terms"))


class Tagger:
    """A fitted pipeline with its tag vocabulary."""

    def __init__(self, pipeline: PipelineModel, tags: list[str], buckets: int, history: list[float] = ()):
        self.pipeline, self.tags, self.buckets = pipeline, tags, buckets
        self.history = list(history)  # the objective after each iteration; not saved

    def save(self, path: str, mode: str = "error") -> None:
        """Write the pipeline and, as Parquet, the vocabulary; ``mode`` is "error" or "overwrite"."""
        writer = self.pipeline.write()
        (writer.overwrite() if mode == "overwrite" else writer).save(f"{path}/pipeline")
        spark = SparkSession.active()
        rows = [(tag, tag_id, self.buckets) for tag_id, tag in enumerate(self.tags)]
        spark.createDataFrame(rows, "tag string, tag_id int, buckets int").write.mode(mode).parquet(f"{path}/vocabulary")

    @staticmethod
    def load(path: str) -> Tagger:
        rows = SparkSession.active().read.parquet(f"{path}/vocabulary").orderBy("tag_id").collect()
        return Tagger(PipelineModel.load(f"{path}/pipeline"), [row.tag for row in rows], rows[0].buckets)

    def tag_tokens(self, df: DataFrame, tokens: str = "tokens", output: str = "bioes_tags") -> DataFrame:
        """Add the most likely tag of every token; the first one wins a tie."""
        score = self._scorer(SparkSession.active())
        names = F.array(*(F.lit(tag) for tag in self.tags))
        scored = with_features(df, tokens, self.buckets).select(*df.columns, score("_features").alias("_ids"))
        named = scored.select(*df.columns, F.transform("_ids", lambda i: F.get(names, i)).alias(output))
        return fence(named, output)

    def tag_queries(self, df: DataFrame, query: str = "query") -> DataFrame:
        """Tag queries of which nothing else is known: adds ``tokens`` and ``bioes_tags``."""
        tokens = split_line(token_line(clean_text(F.col(query))))
        return self.tag_tokens(df.select("*", tokens.alias("tokens")))

    def tag_examples(self, examples: DataFrame) -> DataFrame:
        """Tag rows of ``token_examples`` by the pipeline itself: adds ``predicted``."""
        names = F.array(*(F.lit(tag) for tag in self.tags))
        scored = self.pipeline.transform(examples)
        return scored.select(*examples.columns, F.get(names, F.col("prediction").cast("int")).alias("predicted"))

    def weight_table(self) -> np.ndarray:
        """Weights by feature number and tag: each number is sent through the hashing stage once.

        Its size is fixed by ``buckets`` and the tag set, not by any data.
        """
        hashing, regression = self.pipeline.stages
        size = TEMPLATES * self.buckets * len(self.tags) * 8
        if size > MAX_WEIGHT_BYTES:
            raise ValueError(f"weights of {size} bytes are too large to broadcast")
        numbers = SparkSession.active().range(TEMPLATES * self.buckets).select(
            F.array(F.col("id").cast("int")).alias("terms"), "id"
        )
        places = np.empty(TEMPLATES * self.buckets, dtype=np.int64)
        for row in hashing.transform(numbers).select("id", hashing.getOutputCol()).collect():
            places[row[0]] = row[1].indices[0]
        return np.ascontiguousarray(regression.coefficientMatrix.toArray().T[places])

    def _scorer(self, spark: SparkSession):
        """Arrow function from flat feature numbers to tag ids."""
        bias = self.pipeline.stages[-1].interceptVector.toArray()
        shared = spark.sparkContext.broadcast((self.weight_table(), bias))

        @F.arrow_udf("array<int>")
        def score(features: pa.Array) -> pa.Array:
            table, base = shared.value
            flat = features.flatten().to_numpy(zero_copy_only=False).reshape(-1, TEMPLATES)
            ids = np.empty(len(flat), dtype=np.int32)
            for start in range(0, len(flat), _SCORE_ROWS):
                part = flat[start:start + _SCORE_ROWS]
                scores = np.tile(base, (len(part), 1))
                for k in range(TEMPLATES):
                    scores += table[part[:, k]]
                ids[start:start + _SCORE_ROWS] = scores.argmax(axis=1)
            lengths = features.value_lengths().to_numpy(zero_copy_only=False) // TEMPLATES
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))

        return score


def train_tagger(
    labelled: DataFrame, buckets: int = BUCKETS, max_iter: int = 30, reg_param: float = 1e-5
) -> Tagger:
    """Fit a tagger on the ``tokens`` and ``bioes_tags`` of a labelled table."""
    # A closed set of 13 tags, which fixes the number of classes.
    tags = [row.tag for row in tag_vocabulary(labelled).orderBy("tag_id").collect()]
    ids = F.array(*(F.lit(tag) for tag in tags))
    label = (F.array_position(ids, F.col("tag")) - 1).cast("double")
    hashing = HashingTF(inputCol="terms", outputCol="features", numFeatures=HASHED_SIZE)
    vectors = hashing.transform(token_examples(labelled, buckets).select("terms", label.alias("label")))
    regression = LogisticRegression(
        family="multinomial", maxIter=max_iter, regParam=reg_param, standardization=False
    ).fit(vectors.select("features", "label"))
    return Tagger(PipelineModel([hashing, regression]), tags, buckets, regression.summary.objectiveHistory)
