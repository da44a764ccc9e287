"""Keep-first de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of the rows with equal keys the first by order, all columns.

    An aggregate with map-side combination, not a window: a key of many rows does
    not meet in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    least = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(least).select(*keys, "_first.*").select(*df.columns)
