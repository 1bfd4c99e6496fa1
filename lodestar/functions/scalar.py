"""Scalar Column helpers.

All helpers return ``pyspark.sql.Column`` built from built-in functions, so
they stay inside whole-stage codegen.  Timestamp helpers work on
``TIMESTAMP_NTZ`` without going through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col_of",
    "r_mod",
    "safe_div",
    "epoch_seconds",
    "seconds_between",
    "minutes_between",
    "round_to_unit",
    "round_to_hour",
    "weekday_label",
    "make_day",
    "z_score",
    "scalar_of",
    "strict_between",
    "is_missing",
    "round_half_up",
]



def col_of(c: str | Column) -> Column:
    """Accept a column name, a trusted SQL expression string, or a Column."""
    if isinstance(c, Column):
        return c
    return F.expr(c)


def r_mod(x: str | Column, y: str | Column) -> Column:
    """Modulo that takes the divisor's sign, like R's ``%%``."""
    x, y = col_of(x), col_of(y)
    return ((x % y) + y) % y


def safe_div(x: str | Column, y: str | Column) -> Column:
    """Division that yields NULL on a zero divisor even with ANSI mode on."""
    return F.try_divide(col_of(x), col_of(y))


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ (fraction dropped)."""
    return F.unix_timestamp(col_of(ts))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in whole seconds."""
    return epoch_seconds(end) - epoch_seconds(start)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in minutes as a double."""
    return seconds_between(start, end) / F.lit(60.0)


def round_to_unit(ts: str | Column, seconds: int) -> Column:
    """Round a timestamp to the nearest multiple of ``seconds`` (half up).

    Computed on epoch seconds so the result does not depend on the session
    time zone; returns TIMESTAMP_NTZ.
    """
    half = seconds // 2
    bucket = F.floor((epoch_seconds(ts) + F.lit(half)) / F.lit(seconds)) * F.lit(seconds)
    return F.timestamp_add("SECOND", bucket, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def round_to_hour(ts: str | Column) -> Column:
    """``round_date(ts, "hour")``."""
    return round_to_unit(ts, 3600)


def weekday_label(d: str | Column) -> Column:
    """Abbreviated English weekday name, e.g. ``Mon``."""
    return F.date_format(col_of(d), "E")


def make_day(y: str | Column, m: str | Column, d: str | Column) -> Column:
    """Date from year, month, day parts."""
    return F.make_date(col_of(y), col_of(m), col_of(d))


def scalar_of(df: DataFrame, agg: Column) -> Column:
    """Scalar subquery of a one-row aggregate over ``df``.

    Spark runs the subquery once and hands the value to every task; several
    scalars over the same input are merged into one scan by the optimizer.
    This replaces the client round trip of the two-pass pattern and avoids a
    window without a partition key.
    """
    return df.select(agg).scalar()


def z_score(df: DataFrame, x: str | Column) -> Column:
    """``(x - avg(x)) / stddev_samp(x)`` over the whole of ``df``."""
    c = col_of(x)
    return safe_div(c - scalar_of(df, F.avg(c)), scalar_of(df, F.stddev_samp(c)))


def strict_between(x: str | Column, lo, hi) -> Column:
    """Open interval ``lo < x < hi`` (P12); ``between`` is closed."""
    c = col_of(x)
    return (c > F.lit(lo)) & (c < F.lit(hi))


def is_missing(x: str | Column) -> Column:
    """NULL, or NaN for floating columns."""
    c = col_of(x)
    return c.isNull() | F.isnan(c)


def round_half_up(x: str | Column, digits: int = 0) -> Column:
    """Rounds half away from zero, like SQL ``round``: ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``,
    computed with the same IEEE operations on every engine (F08)."""
    scale = 10 ** digits
    size = F.floor(F.abs(col_of(x)) * F.lit(scale) + F.lit(0.5))
    v = F.when(col_of(x) < 0, -size).otherwise(size)
    return v if digits == 0 else v / F.lit(scale)
