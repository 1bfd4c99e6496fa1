"""Joins (J01-J11).

No join carries a broadcast hint: Spark broadcasts a side by its size in bytes
(from statistics, or at run time when the shuffled side turns out small) and
sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL, so a group with a NULL key keeps its rows."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__right_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__right_{k}" for k in keys])


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    how: str = "left",
) -> DataFrame:
    """Join a fact table to a lookup.

    ``on`` is a key name, a list of shared names, or ``{fact_col: dim_col}``
    for keys with different names (J01).  The dimension's key columns are
    dropped from the output when the names differ.
    """
    if isinstance(on, str) or (isinstance(on, Sequence) and not isinstance(on, Mapping)):
        return fact.join(dim, on=on, how=how)
    cond = None
    for left, right in on.items():
        c = fact[left] == dim[right]
        cond = c if cond is None else cond & c
    out = fact.join(dim, on=cond, how=how)
    for left, right in on.items():
        if left != right:
            out = out.drop(dim[right])
    return out


def assert_unique_key(lookup: DataFrame, key: str | Sequence[str]) -> None:
    """Raise if ``key`` repeats in ``lookup`` (duplicate keys multiply rows)."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = lookup.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"lookup key {keys} is not unique")


def role_join(
    fact: DataFrame,
    lookup: DataFrame,
    lookup_key: str,
    roles: Mapping[str, str],
    columns: Mapping[str, str],
    how: str = "left",
    check_unique: bool = False,
) -> DataFrame:
    """Role-playing dimension: join the same lookup once per role.

    ``roles`` maps a prefix to the fact column that holds the key, e.g.
    ``{"pickup": "pickup_gid", "dropoff": "dropoff_gid"}``; ``columns`` maps
    lookup columns to suffixes, e.g. ``{"ntaname": "nta"}`` giving
    ``pickup_nta`` and ``dropoff_nta``.
    """
    if check_unique:
        assert_unique_key(lookup, lookup_key)
    small = lookup.select(lookup_key, *columns)
    out = fact
    for prefix, fact_key in roles.items():
        renamed = small.select(
            F.col(lookup_key).alias(f"__{prefix}_key"),
            *[F.col(c).alias(f"{prefix}_{suffix}") for c, suffix in columns.items()],
        )
        out = out.join(renamed, out[fact_key] == renamed[f"__{prefix}_key"], how).drop(
            f"__{prefix}_key"
        )
    return out


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name the two sides share."""
    common = sorted(set(a.columns) & set(b.columns))
    if not common:
        raise ValueError("natural join: no common columns")
    return a.join(b, on=common, how=how)


def semi_join(a: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``a`` whose key appears in ``keys``."""
    return a.join(keys, on=on, how="left_semi")


def anti_join(a: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``a`` whose key does not appear in ``keys``."""
    return a.join(keys, on=on, how="left_anti")
