"""A fence that keeps costly columns from being computed a second time.

The optimizer moves a filter below a projection by copying the projected expressions into the
filter, level by level, however large they grow; exploding an array adds such a filter on its
own. Behind a generator that yields one row, a filter on a fenced column stays above it, while
filters on all other columns, partition columns among them, still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, *computed: str) -> DataFrame:
    """The same table with the ``computed`` columns fenced; they come last, in the given order."""
    rest = [name for name in df.columns if name not in computed]
    return df.select(*rest, F.inline_outer(F.array(F.struct(*computed))))
