"""Slots of tagged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotweave.functions.entities import extract_entities, predicted_slots
from slotweave.operators.fence import fence

SLOT_COLUMNS = ("brand_pred", "attributes_pred", "product_type_pred")
LEADERBOARD_COLUMNS = ("query", "brand", "attributes_pred", "product_type", "attributes")


def decode_slots(df: DataFrame, tokens: str = "tokens", tags: str = "bioes_tags") -> DataFrame:
    """Add ``brand_pred``, ``attributes_pred`` and ``product_type_pred`` to a tagged table."""
    decoded = df.select("*", extract_entities(F.col(tokens), F.col(tags)).alias("_entities"))
    slots = decoded.select(*df.columns, *predicted_slots(F.col("_entities")))
    return fence(slots, *SLOT_COLUMNS)


def leaderboard(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Submission table: predicted slots under their plain names, attributes joined by ``|``."""
    return df.select(
        *keep, "query",
        F.col("brand_pred").alias("brand"),
        "attributes_pred",
        F.col("product_type_pred").alias("product_type"),
        F.array_join("attributes_pred", "|").alias("attributes"),
    )
