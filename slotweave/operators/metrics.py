"""Scores of predicted slots and predicted tags. Every score is one pass over its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IGNORED_LABEL = -100

# Truth column, prediction column and metric prefix of each slot.
SINGLE_SLOTS = (("brand", "brand_pred", "brand"), ("product_type", "product_type_pred", "product_type"))
LIST_SLOT = ("attributes", "attributes_pred", "attribute")


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _texts(items: Column) -> Column:
    return F.coalesce(items, F.array().cast("array<string>"))


def is_exact_match(df: DataFrame) -> Column:
    """All slots right: equal brand, equal product type, equal attribute sets; NULL is never equal."""
    truth, predicted, _ = LIST_SLOT
    same = F.array_sort(F.array_distinct(_texts(df[truth]))) == F.array_sort(
        F.array_distinct(_texts(df[predicted]))
    )
    for single, single_predicted, _ in SINGLE_SLOTS:
        same = same & (df[single] == df[single_predicted])
    return F.coalesce(same, F.lit(False))


def top1_accuracy(df: DataFrame) -> Column:
    """Share of rows with all slots right; NaN for no rows."""
    share = F.avg(is_exact_match(df).cast("double"))
    return F.coalesce(share, F.lit(float("nan"))).alias("top1_accuracy")


def single_slot_scores(df: DataFrame, truth: str, predicted: str, name: str) -> list[Column]:
    """Micro-averaged precision and recall over string classes: both are the share of equal rows."""
    equal = F.coalesce(df[truth], F.lit("")) == df[predicted]
    share = F.coalesce(F.avg(equal.cast("double")), F.lit(0.0))
    return [share.alias(f"{name}_precision"), share.alias(f"{name}_recall")]


def list_slot_scores(df: DataFrame, truth: str, predicted: str, name: str) -> list[Column]:
    """Micro-averaged precision and recall over the pooled labels of each row.

    Both classes, "label present" and "label absent", are averaged, which makes the two
    scores equal: the labels in both lists over the labels in either.
    """
    true, pred = _texts(df[truth]), _texts(df[predicted])
    share = _ratio(F.sum(F.size(F.array_intersect(true, pred))), F.sum(F.size(F.array_union(true, pred))))
    return [share.alias(f"{name}_precision"), share.alias(f"{name}_recall")]


def entity_scores(true: Column, pred: Column, name: str) -> list[Column]:
    """Precision, recall and F1 over whole entities; the arrays count as sets."""
    hits = F.sum(F.size(F.array_intersect(true, pred)))
    predicted, expected = F.sum(F.size(F.array_distinct(pred))), F.sum(F.size(F.array_distinct(true)))
    return [
        _ratio(hits, predicted).alias(f"{name}_entity_precision"),
        _ratio(hits, expected).alias(f"{name}_entity_recall"),
        _ratio(2 * hits, predicted + expected).alias(f"{name}_entity_f1"),
    ]


METRIC_NAMES = (
    "top1_accuracy", "brand_precision", "brand_recall", "attribute_precision", "attribute_recall",
    "product_type_precision", "product_type_recall",
)


def slot_scores(df: DataFrame) -> list[Column]:
    """The seven scores of a leaderboard run, in the order of ``METRIC_NAMES``."""
    (brand, product_type), attributes = SINGLE_SLOTS, LIST_SLOT
    return [
        top1_accuracy(df),
        *single_slot_scores(df, *brand),
        *list_slot_scores(df, *attributes),
        *single_slot_scores(df, *product_type),
    ]


def slot_metrics(df: DataFrame) -> DataFrame:
    """The seven scores as one row."""
    return df.agg(*slot_scores(df))


def entity_metrics(df: DataFrame) -> DataFrame:
    """Entity-level precision, recall and F1 of every slot, as one row."""

    def as_set(text: Column) -> Column:
        return F.when(F.coalesce(text, F.lit("")) != "", F.array(text)).otherwise(
            F.array().cast("array<string>")
        )

    scores = []
    for truth, predicted, name in SINGLE_SLOTS:
        scores += entity_scores(as_set(df[truth]), as_set(df[predicted]), name)
    truth, predicted, name = LIST_SLOT
    return df.agg(*scores, *entity_scores(_texts(df[truth]), _texts(df[predicted]), name))


def drop_ignored(labels: Column, predictions: Column) -> Column:
    """Array of ``(label, prediction)`` structs without the positions whose label is ignored."""
    pairs = F.zip_with(
        labels, predictions, lambda a, b: F.struct(a.alias("label"), b.alias("prediction"))
    )
    return F.filter(pairs, lambda pair: pair["label"] != IGNORED_LABEL)


def tag_pairs(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row per token: columns ``truth`` and ``predicted`` from two arrays of equal length."""
    pairs = F.zip_with(
        F.col(truth), F.col(predicted), lambda a, b: F.struct(a.alias("truth"), b.alias("predicted"))
    )
    return df.select(F.inline(pairs))


def span_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 over whole well-formed spans, and their number, as one row.

    A span is right if places and type are. Each row's arrays are read as one line of tags with their places, in which a
    pattern finds the spans.
    """

    def spans(tags: str) -> Column:
        cells = F.transform(tags, lambda tag, k: F.concat(F.lit(" "), F.coalesce(tag, F.lit("O")), F.lit("@"), k.cast("string")))
        pattern = r" (?:S-\S+|B-([^@\s]+)@\d+(?: I-\1@\d+)*+ E-\1@\d+)"
        return F.regexp_extract_all(F.array_join(cells, ""), F.lit(pattern), F.lit(0))

    rows = df.select(spans(truth).alias("true"), spans(predicted).alias("found"))
    hits, expected, found = F.sum(F.size(F.array_intersect("true", "found"))), F.sum(F.size("true")), F.sum(F.size("found"))
    return rows.agg(
        _ratio(hits, found).alias("precision"), _ratio(hits, expected).alias("recall"),
        _ratio(2 * hits, found + expected).alias("f1"), F.coalesce(expected, F.lit(0).cast("bigint")).alias("support"))


def classification_report(pairs: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per label, then accuracy, macro and weighted averages.

    One pass over the pairs counts them; all further steps see one row per pair of labels.
    The rows carry ``position``: labels in sorted order come first.
    """
    confusion = pairs.groupBy(
        F.col(truth).cast("string").alias("t"), F.col(predicted).cast("string").alias("p")
    ).count()
    n = F.col("count")
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("t").alias("label"), n.alias("support"), zero.alias("predicted"),
                 F.when(F.col("t") == F.col("p"), n).otherwise(zero).alias("hits")),
        F.struct(F.col("p").alias("label"), zero.alias("support"), n.alias("predicted"), zero.alias("hits")),
    )
    per_label = (
        confusion.select(F.inline(sides))
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .select(
            "label", "support", "hits",
            _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
            _ratio(F.col("hits"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        )
    )
    scores = ("precision", "recall", "f1")

    def weighted(name: str) -> Column:
        return _ratio(F.sum(F.col(name) * F.col("support")), F.sum("support")).alias(f"weighted_{name}")

    rolled = per_label.rollup("label").agg(
        F.grouping("label").alias("is_total"),
        *(F.avg(name).alias(name) for name in scores),
        *(weighted(name) for name in scores),
        F.sum("support").alias("support"),
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
    )

    def row(position: int, label: Column, values: list[Column]) -> Column:
        named = [value.alias(name) for name, value in zip(scores, values)]
        return F.struct(F.lit(position).alias("position"), label.alias("label"), *named, F.col("support"))

    missing = F.lit(None).cast("double")
    totals = F.array(
        row(1, F.lit("accuracy"), [missing, missing, F.col("accuracy")]),
        row(2, F.lit("macro avg"), [F.col(name) for name in scores]),
        row(3, F.lit("weighted avg"), [F.col(f"weighted_{name}") for name in scores]),
    )
    label_row = F.array(row(0, F.col("label"), [F.col(name) for name in scores]))
    return (
        rolled.where((F.col("is_total") == 0) | F.col("support").isNotNull())
        .select(F.inline(F.when(F.col("is_total") == 1, totals).otherwise(label_row)))
        .orderBy("position", "label")
    )
