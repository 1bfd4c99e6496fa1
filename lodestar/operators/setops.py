"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_union(parts: Mapping[str, DataFrame], tag_col: str = "data") -> DataFrame:
    """Append frames by column name with a source tag column first."""
    tagged = [df.select(F.lit(tag).alias(tag_col), *df.columns) for tag, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set union of whole rows."""
    return a.unionByName(b).distinct()


def intersect_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in both."""
    return a.intersect(b)


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` not in ``b``."""
    return a.subtract(b)
