"""Output normalisation shared by the Spark queries and their SQL twins.

Integers become BIGINT, floating values are rounded to 4 decimals with
``floor(x * 1e4 + 0.501) / 1e4``: the same IEEE operations in Spark and in
DuckDB (their ``round`` functions differ at halves), with the cut moved a
hair below the half so that exact decimal halves such as ``61.72835`` -- a
common mean of money values -- are not split by last-bit differences in
the two engines' summation order.  Dates and timestamps become ISO text.
Applied only at the edge, for result comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 10_000
HALF = 0.501


def conform(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("long")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.floor(c.cast("double") * F.lit(SCALE) + F.lit(HALF)) / F.lit(SCALE)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def r4(expr: str) -> str:
    """SQL twin of the floating-point rounding in ``conform``."""
    return f"(floor(({expr}) * {SCALE} + {HALF}) / {SCALE})"


def i8(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def day_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
