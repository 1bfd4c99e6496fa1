"""Projection, filter, recode and sampling verbs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.scalar import col_of
from lodestar.operators import sampling


def select_range(df: DataFrame, first: str, last: str, *extra: str) -> DataFrame:
    """``select(year:day, x)``: a contiguous slice of columns plus extras."""
    cols = df.columns
    lo, hi = cols.index(first), cols.index(last)
    if lo > hi:
        lo, hi = hi, lo
    return df.select(*cols[lo : hi + 1], *extra)


def select_as(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Project with rename: ``{new_name: source column or expression}``."""
    return df.select(*[col_of(src).alias(new) for new, src in mapping.items()])


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """``select(-x)``."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``rename(new = old)`` given as ``{old: new}``."""
    return df.withColumnsRenamed(dict(mapping))


def derive(df: DataFrame, exprs: Mapping[str, str | Column]) -> DataFrame:
    """``mutate``: columns are added in order, so later ones may use earlier ones."""
    out = df
    for name, e in exprs.items():
        out = out.withColumn(name, col_of(e))
    return out


def where_all(df: DataFrame, *conds: str | Column) -> DataFrame:
    """Conjunction of predicates, like ``filter(a, b)``."""
    out = df
    for c in conds:
        out = out.where(col_of(c))
    return out


def where_any(df: DataFrame, *conds: str | Column) -> DataFrame:
    """Disjunction of predicates."""
    cond = None
    for c in conds:
        cond = col_of(c) if cond is None else cond | col_of(c)
    return df.where(cond)


def in_list(df: DataFrame, column: str | Column, values: Sequence, lower: bool = False) -> DataFrame:
    """``x %in% c(...)``, optionally after ``lower`` (P10).  SQL three-valued logic: NULL never matches."""
    c = col_of(column)
    if lower:
        c = F.lower(c)
    return df.where(c.isin(list(values)))


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``!is.na(a) & !is.na(b)`` / ``na.omit``."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of one column."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def frequent_keys(df: DataFrame, key: str, cutoff: int, name: str = "n") -> DataFrame:
    """Keys seen more than ``cutoff`` times, NULL key excluded."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(name))
        .where(F.col(name) > cutoff)
    )


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Each row kept with probability ``fraction``."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_about(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """About ``n`` rows: fraction = n / count."""
    total = df.count()
    return df if total <= n else df.sample(False, n / total, seed)


def sample_exact(df: DataFrame, n: int, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``min(n, count)`` rows chosen by a seeded hash of ``key`` (default: all columns) (P17); see ``sampling``."""
    return sampling.sample_exact(df, n, key, seed)


def random_split(df: DataFrame, weights: Mapping[str, float], seed: int = 42) -> dict[str, DataFrame]:
    """Seeded split by normalised weights, returned by name."""
    names = list(weights)
    parts = df.randomSplit([float(weights[k]) for k in names], seed)
    return dict(zip(names, parts))


def hash_split(
    df: DataFrame, weights: Mapping[str, float], key: Sequence[str] | str, seed: int = 42
) -> dict[str, DataFrame]:
    """Deterministic split on the portable row hash of ``key`` (``sampling.row_hash``): independent of
    partitioning and re-runs; parts are disjoint and cover the input, and the cut points are exact to
    2**-60 of the weights (P18)."""
    total = sum(Fraction(w) for w in weights.values())
    h = sampling.row_hash(key, seed)
    out, done, lo = {}, Fraction(0), 0
    for name, weight in weights.items():
        done += Fraction(weight)
        hi = round(done / total * 2**sampling.HASH_BITS)
        out[name] = df.where((h >= F.lit(lo)) & (h < F.lit(hi)))
        lo = hi
    return out


def brush(df: DataFrame, x: str, y: str, xmin=None, xmax=None, ymin=None, ymax=None) -> DataFrame:
    """Rows inside a closed rectangle on (x, y); a side without a bound is open, no bounds mean the whole table."""
    for col, lo, hi in ((x, xmin, xmax), (y, ymin, ymax)):
        if lo is not None:
            df = df.where(F.col(col) >= F.lit(lo))
        if hi is not None:
            df = df.where(F.col(col) <= F.lit(hi))
    return df


def recode_when(key: str | Column, mapping: Mapping, default=None, otherwise_col: str | Column | None = None) -> Column:
    """``ifelse`` chain: value -> label, else ``default`` or another column."""
    c = col_of(key)
    expr = None
    for k, v in mapping.items():
        cond = c == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    tail = col_of(otherwise_col) if otherwise_col is not None else F.lit(default)
    return tail if expr is None else expr.otherwise(tail)


def normalise_codes(key: str | Column, domain: Mapping[str, Sequence[str]], default: str = "unk") -> Column:
    """Map dirty codes to a small domain after ``lower(trim())``; NULL lands in ``default``."""
    c = F.lower(F.trim(col_of(key)))
    expr = None
    for label, codes in domain.items():
        cond = c.isin([x.lower() for x in codes])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def bucket_closed_right(x: str | Column, edges: Sequence[float]) -> Column:
    """R ``cut(x, edges)``: bins ``(e_i, e_i+1]`` numbered from 0, NULL outside."""
    c = col_of(x)
    expr = None
    for i in range(len(edges) - 1):
        cond = (c > F.lit(edges[i])) & (c <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    return expr


def bucket_closed_left(x: str | Column, edges: Sequence[float]) -> Column:
    """``Bucketizer`` rule as a Column: ``[e_i, e_i+1)``, last bin closed, NULL outside."""
    c = col_of(x)
    expr = None
    last = len(edges) - 2
    for i in range(len(edges) - 1):
        upper = (c <= F.lit(edges[i + 1])) if i == last else (c < F.lit(edges[i + 1]))
        cond = (c >= F.lit(edges[i])) & upper
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    return expr
