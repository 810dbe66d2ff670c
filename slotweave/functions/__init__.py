"""Column functions: text, attribute lists, BIOES spans, entities."""

from slotweave.functions.attributes import attribute_list, clean_attribute_list, parse_attributes
from slotweave.functions.entities import extract_entities, predicted_slots
from slotweave.functions.spans import LABELS, TAGS, apply_bioes_tags, encode_span
from slotweave.functions.text import clean_text, is_brand_in_query, tokenize_query

__all__ = [
    "LABELS", "TAGS", "apply_bioes_tags", "attribute_list", "clean_attribute_list", "clean_text",
    "encode_span", "extract_entities", "is_brand_in_query", "parse_attributes", "predicted_slots",
    "tokenize_query",
]
