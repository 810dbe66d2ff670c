"""Input columns: the four required names, their alternates, and text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.functions.attributes import number_text

# Required column names and the alternate spelling of each.
ALTERNATE_NAMES = {
    "query": "Query",
    "brand": "Brand",
    "product_type": "Product_type",
    "attributes": "Attributes",
}
ERROR = "error"


def source_name(names: list[str], required: str) -> str | None:
    """The column to read for a required name: the exact name, else its alternate, else none."""
    for name in (required, ALTERNATE_NAMES[required]):
        if name in names:
            return name
    return None


def as_text(value: Column, data_type: T.DataType) -> Column:
    """Text of a column of any scalar type; NaN counts as missing."""
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.BooleanType):
        return F.initcap(value.cast("string"))
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), number_text(value.cast("double")))
    return value.cast("string")


def normalize_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns first, then query, brand, product_type, attributes, and error if given.

    A missing column becomes ''. Attributes keep their type, the other three become text.
    """
    names, types = df.columns, {field.name: field.dataType for field in df.schema}
    exact = [F.col(f"`{name}`") for name in keep]
    for required in ALTERNATE_NAMES:
        name = source_name(names, required)
        if name is None:
            value = F.lit("")
        elif required == "attributes":
            value = F.col(f"`{name}`")
        else:
            value = as_text(F.col(f"`{name}`"), types[name])
        exact.append(value.alias(required))
    if ERROR in names:
        exact.append(F.col(ERROR))
    return df.select(*exact)
