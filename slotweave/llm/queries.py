"""The registered queries of the operators on text corpora; each reads whole tables of ``folder``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.llm import (
    byte_bpe,
    fill_in_middle,
    fingerprints,
    license_scan,
    near_duplicates,
    packing,
    pii,
    quality_model,
    quotations,
    toxicity_model,
    url_filters,
    weak_supervision,
    whitening,
)
from slotweave.llm.labelled import remainder
from slotweave.llm.oracles import FILL_IN_MIDDLE_SQL, URL_FILTER_SQL
from slotweave.llm.shared import written


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near copies of every document; ``stays`` marks the one of each class to keep."""
    return near_duplicates.classes(_table(spark, folder, "documents")).select("doc_id", "class_id", "stays")


def op7_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    """All messages in reply order's terms, without quotes."""
    return quotations.conversations(_table(spark, folder, "conversations"))


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; learned from the labels whose remainder by 3 is not 1."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    model = quality_model.fit(docs, _table(spark, folder, "labels"), metadata=("n_chars",))
    return quality_model.score(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in every document."""
    return license_scan.summary(license_scan.scan(_table(spark, folder, "documents")))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle fingerprints of every document and its edited text, and how near they and the next document's are."""
    rows = fingerprints.with_tree(
        fingerprints.edited_by_next(_table(spark, folder, "documents")), "edited", "edited_tree")
    for tree in ("tree", "edited_tree", "next_tree"):
        rows = fingerprints.with_nodes(rows, tree, f"{tree}_nodes")
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.rendered("tree").alias("fingerprint"), fingerprints.rendered("edited_tree").alias("edited_fingerprint"),
        fingerprints.likeness("tree", "tree_nodes", "edited_tree", "edited_tree_nodes").alias("near_edited"),
        fingerprints.likeness("tree", "tree_nodes", "next_tree", "next_tree_nodes").alias("near_next"),
        F.size(fingerprints.differing_paragraphs("tree", "edited_tree")).alias("n_differing"),
    )


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, the hard rules and the verdict of the voting rules for every document."""
    table = written(weak_supervision.rule_table(_table(spark, folder, "documents")), "op3")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return weak_supervision.judge(table).select(
        "doc_id", *weak_supervision.COUNTS, failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= 0.5)).alias("kept"), "posterior",
    )


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document; the counts and ``base_sha256`` are of the undisguised ones."""
    def joined(spans: str) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))

    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in pii.KINDS]
    return pii.detect(_table(spark, folder, "documents")).select(
        "doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; learned from the labels whose remainder by 4 is not 2."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity_model.fit(docs, _table(spark, folder, "labels"))
    return toxicity_model.score(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Number of ids of every document, and digests of the ids and of what they decode to."""
    return byte_bpe.round_trip(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut and put in another order, and what is restored from that."""
    output, form = F.col("output"), F.col("form")
    return fill_in_middle.transform(_table(spark, folder, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(output, form), 256).alias("restored_sha256"))


def op12_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL, with the rule or the terms that lead to it."""
    return url_filters.judge(_table(spark, folder, "pages")).drop("n_hits")


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first eight whitened components of every embedding; ``deviation`` is null where it needs more than 64 bits."""
    rows = whitening.usable(_table(spark, folder, "embeddings"))
    model = whitening.fit(rows)
    if model is None:
        return spark.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = whitening.identity_error(rows, model)
    return whitening.whiten(rows, model).select(
        "vec_id", "component", F.lit(model.rows).cast("long").alias("n"), F.col("deviation").try_cast("long").alias("deviation"),
        "whitened", "explained", F.lit(error).alias("identity_error"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_fingerprints": op2_fingerprints,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_quotation_linking": op7_quotation_linking,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_packing": op10_packing,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_url_filters": op12_url_filters,
    "op13_whitening": op13_whitening,
}
ORACLES = {
    "op11_fill_in_middle": FILL_IN_MIDDLE_SQL,
    "op12_url_filters": URL_FILTER_SQL,
}
