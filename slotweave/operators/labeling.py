"""The weak labeller: BIOES tags for every query token, from known slot values.

``label_queries`` is map-only: a chain of projections over one scan, no shuffle, no Python worker.
Each projection names values that the next one uses more than once, so that the optimizer
keeps them apart and every text is cleaned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.functions.attributes import attribute_list
from slotweave.functions.spans import entity_line, mark_entity, padded, span_line, tag_line
from slotweave.functions.text import clean_text, contains_brand, split_line, token_line
from slotweave.operators.columns import ERROR, normalize_columns
from slotweave.operators.fence import fence

OUTPUT_COLUMNS = (
    "query", "brand", "attributes", "product_type", "tokens", "bioes_tags",
    "augmented_query", "brand_added", ERROR,
)


def tag_attributes(marked: Column, attribute_lines: Column) -> Column:
    """Tag the attributes one after the other; earlier tags block later ones."""
    return F.aggregate(
        attribute_lines, marked, lambda line, entity: mark_entity(line, entity, "Attribute")
    )


def _clean_inputs(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Clean texts, parsed attributes; texts of failed rows stay as they came."""
    failed = F.col(ERROR).isNotNull() if ERROR in df.columns else F.lit(False)
    error = F.col(ERROR) if ERROR in df.columns else F.lit(None).cast("string")
    return df.select(
        *keep,
        F.when(failed, F.col("query")).otherwise(clean_text(F.col("query"))).alias("query"),
        F.when(~failed, clean_text(F.col("brand"))).alias("brand"),
        F.when(~failed, attribute_list(F.col("attributes"), df.schema["attributes"].dataType)).alias("attributes"),
        F.when(~failed, clean_text(F.col("product_type"))).alias("product_type"),
        error.alias(ERROR),
    )


def _token_lines(df: DataFrame) -> DataFrame:
    """Token lines of every text; a failed row gets the empty query line."""
    query = F.when(F.col(ERROR).isNull(), F.col("query")).otherwise("")
    return df.select(
        "*",
        token_line(query).alias("_line"),
        token_line(F.col("brand")).alias("_brand_line"),
        F.transform(F.col("attributes"), entity_line).alias("_attribute_lines"),
        entity_line(F.col("product_type")).alias("_type_line"),
        contains_brand(F.col("brand"), query).alias("_brand_found"),
    )


def _tag_brands(df: DataFrame) -> DataFrame:
    """Open the marked line and tag the brand; note whether the brand is to be appended."""
    line = padded(F.col("_line"))
    return df.select(
        "*",
        F.when(F.col("_brand_found"), mark_entity(line, padded(F.col("_brand_line")), "Brand"))
        .otherwise(line).alias("_with_brand"),
        ((F.col("_line") != "") & (F.col("brand") != "") & ~F.col("_brand_found")).alias("_append"),
    )


def _tag_rest(df: DataFrame) -> DataFrame:
    """Tag attributes, then the product type."""
    tagged = F.when(
        F.size("_attribute_lines") > 0, tag_attributes(F.col("_with_brand"), F.col("_attribute_lines"))
    ).otherwise(F.col("_with_brand"))
    with_attributes = df.select("*", tagged.alias("_with_attributes"))
    return with_attributes.select(
        "*", mark_entity(F.col("_with_attributes"), F.col("_type_line"), "ProductType").alias("_marked")
    )


def _results(df: DataFrame, keep: tuple[str, ...], outputs: tuple[str, ...]) -> DataFrame:
    """Token and tag arrays; a brand that the query lacks is appended with its own span."""
    brand_line = F.col("_brand_line")
    brand_tags = span_line(padded(brand_line), "Brand")

    def appended(base: Column, extra: Column) -> Column:
        return F.concat(base, F.when(F.col("_append"), extra).otherwise(""))

    def spaced(extra: Column) -> Column:
        return F.concat(F.lit(" "), extra)

    done = F.col(ERROR).isNull()
    made = {
        "tokens": split_line(appended(F.col("_line"), spaced(brand_line))),
        "bioes_tags": split_line(appended(tag_line(F.col("_marked")), brand_tags)),
        "augmented_query": F.when(done, appended(F.col("query"), spaced(F.col("brand")))),
        "brand_added": F.when(done, F.col("_append")),
    }
    return df.select(*keep, *(made[name].alias(name) if name in made else F.col(name) for name in outputs))


def label_queries(df: DataFrame, keep: tuple[str, ...] = (), outputs: tuple[str, ...] = OUTPUT_COLUMNS) -> DataFrame:
    """Label a query table. ``keep`` names further input columns to carry along, unchanged.

    Rows with an ``error`` are kept with empty token and tag arrays. ``outputs`` names the results that are wanted:
    the fence hides from the optimizer which of them are used, so what is not asked for is not computed.
    """
    cleaned = _clean_inputs(normalize_columns(df, keep), keep)
    results = _results(_tag_rest(_tag_brands(_token_lines(cleaned))), keep, outputs)
    return fence(results, *outputs)
