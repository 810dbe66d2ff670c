"""Training data: split, tag vocabulary, and labels aligned to sub-tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.functions.spans import TAGS
from slotweave.functions.subwords import Vocabulary, subwords
from slotweave.operators.fence import fence
from slotweave.operators.metrics import IGNORED_LABEL

MAX_LENGTH = 128


def split_bucket(keys: list[Column], seed: int = 0) -> Column:
    """Bucket 0..99 of a row, from a digest of its keys: the same in every run and engine."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(key.cast("string") for key in keys)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def train_validation_split(
    df: DataFrame, keys: tuple[str, ...] = ("query",), percent: int = 20, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows, about ``percent`` % of the keys in the latter; no shuffle.

    Equal keys stay on one side, so equal queries cannot leak. Where one query makes up a large
    part of the rows, add a row id to ``keys`` to keep the share of rows near ``percent``.
    """
    validation = split_bucket([F.col(key) for key in keys], seed) < percent
    return df.where(~validation), df.where(validation)


def closed_vocabulary(spark: SparkSession) -> DataFrame:
    """``tag``, ``tag_id`` of the labeller's 13 tags in sorted order, numbered from 0; no data is read."""
    return spark.createDataFrame(list(zip(sorted(TAGS), range(len(TAGS)))), "tag string, tag_id int")


def tag_vocabulary(df: DataFrame, tags: str = "bioes_tags") -> DataFrame:
    """``tag``, ``tag_id``: the tags that occur, in sorted order, numbered from 0; an unknown tag is an error.

    The tags of the labeller form a closed set of 13, whatever the size of the input.
    """
    tag = F.col("tag")
    checked = F.when(tag.isin(*TAGS), tag).otherwise(F.raise_error(F.concat(F.lit("unknown tag "), tag)))
    distinct = df.select(F.explode(tags).alias("tag")).select(checked.alias("tag")).distinct()
    ordered = distinct.agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    return ordered.select(F.posexplode("tags").alias("tag_id", "tag")).select("tag", "tag_id")


def _with_map(df: DataFrame, vocabulary: DataFrame, key: str, value: str) -> DataFrame:
    """Add the vocabulary as a map, read once by a scalar subquery."""
    entries = vocabulary.agg(F.map_from_entries(F.collect_list(F.struct(key, value))))
    return df.select("*", entries.scalar().alias("_map"))


def encode_tags(df: DataFrame, vocabulary: DataFrame, tags: str = "bioes_tags", output: str = "tag_ids") -> DataFrame:
    """Add the ids of a tag array."""
    ids = F.transform(tags, lambda tag: F.element_at(F.col("_map"), tag))
    return _with_map(df, vocabulary, "tag", "tag_id").select(*df.columns, ids.alias(output))


def decode_tags(df: DataFrame, vocabulary: DataFrame, ids: str = "tag_ids", output: str = "bioes_tags") -> DataFrame:
    """Add the tags of an id array; ignored positions are left out."""
    kept = F.filter(ids, lambda tag_id: tag_id != IGNORED_LABEL)
    names = F.transform(kept, lambda tag_id: F.element_at(F.col("_map"), tag_id))
    return _with_map(df, vocabulary, "tag_id", "tag").select(*df.columns, names.alias(output))


def align_labels(word_ids: Column, word_labels: Column, max_length: int = MAX_LENGTH) -> Column:
    """Label per sub-token, cut or padded to ``max_length``.

    ``word_ids`` names the word of every sub-token, NULL for special ones. The first piece of
    a word gets its label; later pieces, specials and padding are ignored positions.
    """
    ignored = F.lit(IGNORED_LABEL)

    def label(word: Column, position: Column) -> Column:
        repeats = word.eqNullSafe(F.get(word_ids, position - 1))
        return F.when(word.isNull() | repeats, ignored).otherwise(F.get(word_labels, word))

    # Cut first: what lies beyond has no label, and a label looks no further than one place back.
    cut = F.transform(F.slice(word_ids, 1, max_length), label)
    return F.concat(cut, F.array_repeat(ignored, max_length - F.size(cut)))


def model_inputs(
    df: DataFrame, vocabulary: Vocabulary, tokens: str = "tokens", labels: str = "tag_ids", max_length: int = MAX_LENGTH, **normal,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask``, ``word_ids`` and ``labels`` of ``max_length`` sub-words, and ``n_pieces`` before the cut.

    The special pieces of the vocabulary begin and end each row, also a cut one; padding follows. A word's first piece
    has its label, all else is ignored. ``normal`` are options of ``subwords``.
    """
    kept = [name for name in df.columns if name not in ("input_ids", "attention_mask", "word_ids", "labels", "n_pieces")]
    begin, end = (F.array(*([F.lit(i)] if i is not None else [])).cast("array<int>") for i in (vocabulary.begin, vocabulary.end))
    none = F.lit(None).cast("int")
    nothing = [F.array_repeat(none, int(i is not None)) for i in (vocabulary.begin, vocabulary.end)]
    room = max_length - sum(i is not None for i in (vocabulary.begin, vocabulary.end))
    pieces = fence(df.select("*", subwords(F.col(tokens), vocabulary, **normal).alias("_pieces")), "_pieces")
    cut = pieces.select(
        "*", F.slice("_pieces.ids", 1, room).alias("_ids"), F.slice("_pieces.word_ids", 1, room).alias("_words"))
    ids = F.concat(begin, F.col("_ids"), end)
    words = F.concat(nothing[0], F.col("_words"), nothing[1])
    rest = max_length - F.size(ids)
    return cut.select(
        *kept, F.concat(ids, F.array_repeat(F.lit(vocabulary.pad), rest)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), rest)).alias("attention_mask"),
        F.concat(words, F.array_repeat(none, rest)).alias("word_ids"),
        align_labels(words, F.col(labels), max_length).alias("labels"),
        F.size("_pieces.ids").cast("bigint").alias("n_pieces"),
    )
