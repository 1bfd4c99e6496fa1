"""Least squares from sufficient statistics: one grouped aggregation, any number of fits.

Rows are summed up to counts, means and co-moments of the numeric columns per
combination of the categorical levels (and fold); one-hot columns are constant
within a combination, so the moments of the whole encoded matrix follow from
that small table.  Moments merge and subtract, so a cross-validation leaves a
fold out without another scan, and every penalty of a path is solved from the
same moments.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.distributions import t_two_sided_p_values
from lodestar.operators.rollups import percentile_table

RESIDUAL_QUANTILES = {"res_min": 0.0, "res_q1": 0.25, "res_median": 0.5, "res_q3": 0.75, "res_max": 1.0}


@dataclass(frozen=True)
class Term:
    """An encoded column: a numeric one, or a level of a categorical one."""

    column: str
    level: object = None
    is_level: bool = False

    @property
    def name(self) -> str:
        return f"{self.column}_{self.level}" if self.is_level else self.column

    def value(self) -> Column:
        c = F.col(f"`{self.column}`")
        return F.when(c == F.lit(self.level), 1.0).otherwise(0.0) if self.is_level else c.cast("double")


@dataclass(frozen=True)
class Moments:
    """n, means and co-moments (sums of products about the means) of the terms and, last, the label."""

    terms: tuple[Term, ...]
    n: float
    mean: np.ndarray
    co: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if n == 0:
            return self
        apart = other.mean - self.mean
        co = self.co + other.co + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(self.terms, n, (self.n * self.mean + other.n * other.mean) / n, co)

    def __sub__(self, other: Moments) -> Moments:
        """What is left when ``other``, a part of these rows, is taken out."""
        n = self.n - other.n
        if n <= 0:
            return Moments(self.terms, 0.0, np.zeros_like(self.mean), np.zeros_like(self.co))
        mean = (self.n * self.mean - other.n * other.mean) / n
        apart = other.mean - mean
        return Moments(self.terms, n, mean, self.co - other.co - np.outer(apart, apart) * (n * other.n / self.n))

    def mse(self, fit: Fit) -> float:
        """Mean squared error of ``fit`` on these rows."""
        b = np.append(-fit.coefficients, 1.0)
        return float(max(0.0, b @ self.co @ b) / self.n + (b @ self.mean - fit.intercept) ** 2)


@dataclass(frozen=True)
class Fit:
    terms: tuple[Term, ...]
    intercept: float
    coefficients: np.ndarray

    def prediction(self) -> Column:
        """The fit as a Column over the raw columns."""
        parts = [F.lit(float(b)) * t.value() for t, b in zip(self.terms, self.coefficients, strict=True)]
        return reduce(lambda x, y: x + y, parts, F.lit(float(self.intercept)))


def moments(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (), fold: Column | None = None, max_groups: int = 100_000
) -> dict[object, Moments]:
    """Moments per value of ``fold`` (one entry, None, without it), from one aggregation.

    Rows with a null in a used column are left out.  A categorical column has
    one term per level but the smallest.  The grouped table has a row per fold
    and combination of levels; more than ``max_groups`` are an error, as such
    columns make no model matrix that the driver could solve.
    """
    columns = [*numeric, label]
    base = df.select(
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(categorical)],
        (F.lit(0) if fold is None else fold).alias("fold"),
    ).dropna()
    keys = ["fold", *[f"k{i}" for i in range(len(categorical))]]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    found = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(columns))],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs],
    )
    rows = found.limit(max_groups + 1).collect()
    if len(rows) > max_groups:
        raise ValueError(f"more than {max_groups} combinations of levels")
    levels = [sorted({r[f"k{i}"] for r in rows})[1:] for i in range(len(categorical))]
    terms = (*[Term(c) for c in numeric], *[Term(c, level, True) for c, kept in zip(categorical, levels, strict=True) for level in kept])
    p, k = len(terms), len(numeric)
    out: dict[object, Moments] = {}
    place = [*range(k), p]  # of the numeric columns and the label among terms and label
    for r in rows:
        mean = np.zeros(p + 1)
        mean[place] = [r[f"m{i}"] for i in range(k + 1)]
        mean[k:p] = [r[f"k{list(categorical).index(t.column)}"] == t.level for t in terms[k:]]
        co = np.zeros((p + 1, p + 1))
        for i, j in pairs:
            co[place[i], place[j]] = co[place[j], place[i]] = r[f"c{i}_{j}"] * r["n"]
        one = Moments(terms, float(r["n"]), mean, co)
        key = None if fold is None else r["fold"]
        out[key] = out[key] + one if key in out else one
    return out


def total(parts: Iterable[Moments]) -> Moments:
    return reduce(lambda a, b: a + b, parts)


def solve(m: Moments, penalty: float = 0.0, elastic: float = 0.0, start: np.ndarray | None = None, tol: float = 1e-12, rounds: int = 100_000) -> Fit:
    """The fit that minimises half the mean squared error plus penalty * (elastic * |b| + (1 - elastic) / 2 * |b|^2).

    b are the coefficients of the terms scaled to unit (population) variance;
    the intercept bears no penalty.  Ridge and least squares are solved
    directly, anything else by coordinate descent from ``start`` (coefficients
    of a neighbouring penalty).  Constant terms get 0; among dependent terms
    without a penalty the smallest coefficients are taken.
    """
    p = len(m.terms)
    spread = np.sqrt(np.maximum(np.diag(m.co)[:p], 0) / max(m.n, 1))
    used = spread > 1e-12 * np.maximum(1.0, np.abs(m.mean[:p]))
    scale = np.where(used, spread, 1.0)
    r = np.where(used[:, None] & used[None, :], m.co[:p, :p] / max(m.n, 1) / np.outer(scale, scale), 0.0)
    xy = np.where(used, m.co[:p, p] / max(m.n, 1) / scale, 0.0)
    ridge = penalty * (1 - elastic)
    if penalty * elastic == 0:
        a = r + ridge * np.eye(p)
        b = np.linalg.solve(a, xy) if ridge > 0 else np.linalg.lstsq(a, xy, rcond=1e-12)[0]
    else:
        b = np.zeros(p) if start is None else start * scale
        for _ in range(rounds):
            moved = 0.0
            for i in np.flatnonzero(used):
                z = xy[i] - r[i] @ b + r[i, i] * b[i]
                new = np.sign(z) * max(abs(z) - penalty * elastic, 0.0) / (r[i, i] + ridge)
                moved, b[i] = max(moved, abs(new - b[i])), new
            if moved <= tol * max(1.0, np.abs(b).max(initial=0.0)):
                break
    coefficients = b / scale
    return Fit(m.terms, float(m.mean[p] - coefficients @ m.mean[:p]), coefficients)


def path(m: Moments, penalties: Sequence[float], elastic: float = 0.0) -> dict[float, Fit]:
    """A fit per penalty, largest first, each starting from the one before."""
    out: dict[float, Fit] = {}
    last = None
    for penalty in sorted(set(penalties), reverse=True):
        out[penalty] = solve(m, penalty, elastic, last)
        last = out[penalty].coefficients
    return out


def penalty_path(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], penalties: Sequence[float], is_valid: Column, elastic: float = 0.0
) -> tuple[dict[float, Fit], DataFrame]:
    """Linear models over a path of penalties, judged on the rows where ``is_valid`` holds.

    One scan, whatever the number of penalties: training and validation errors
    come from the moments of both parts.  The table has penalty, terms kept,
    train_rmse and rmse (validation), best first.
    """
    parts = moments(df, label, numeric, categorical, is_valid)
    train, valid = parts[False], parts[True]
    fits = path(train, penalties, elastic)
    rows = [(float(x), int(np.count_nonzero(f.coefficients)), float(np.sqrt(train.mse(f))), float(np.sqrt(valid.mse(f)))) for x, f in fits.items()]
    rows.sort(key=lambda r: (r[3], r[0]))
    return fits, df.sparkSession.createDataFrame(rows, "penalty double, n_terms int, train_rmse double, rmse double")


def cross_validate(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], penalties: Sequence[float], fold: Column, elastic: float = 0.0
) -> DataFrame:
    """(penalty, fold, n, rmse) of every fold left out, from one scan: its moments are subtracted from the total."""
    parts = moments(df, label, numeric, categorical, fold)
    whole, rows = total(parts.values()), []
    for k, held in sorted(parts.items()):
        for penalty, fit in path(whole - held, penalties, elastic).items():
            rows.append((float(penalty), int(k), int(held.n), float(np.sqrt(held.mse(fit)))))
    return df.sparkSession.createDataFrame(rows, "penalty double, fold int, n long, rmse double")


def linear_summary(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Coefficient table of least squares with R², RMSE and the five residual quantiles on every row.

    Columns: term, estimate, std_error, t_value, p_value, r2, rmse, res_min,
    res_q1, res_median, res_q3, res_max.  Two passes over the rows: moments,
    then the residuals' quantiles; rows with a null in a used column are left
    out of both.  Dependent terms have no standard error of their own and are
    refused.
    """
    m = moments(df, label, numeric, categorical)[None]
    fit, p = solve(m), len(m.terms)
    xx = m.co[:p, :p]
    spread = np.sqrt(np.diag(xx))
    if not spread.all() or np.linalg.matrix_rank(xx / np.outer(spread, spread)) < p:
        raise ValueError("the terms are linearly dependent")
    inverse = np.linalg.inv(xx / np.outer(spread, spread)) / np.outer(spread, spread)
    sse = m.mse(fit) * m.n
    left = m.n - p - 1
    noise = sse / left if left > 0 else np.nan
    variance = np.concatenate([[noise * (1 / m.n + m.mean[:p] @ inverse @ m.mean[:p])], noise * np.diag(inverse)])
    estimate, error = np.concatenate([[fit.intercept], fit.coefficients]), np.sqrt(variance)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = estimate / error
    p_value = t_two_sided_p_values(t, np.full(p + 1, left))
    used = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*numeric, *categorical, label])]).dropna()
    residual = used.select((F.col(f"`{label}`").cast("double") - fit.prediction()).alias("residual"))
    quantiles = percentile_table(residual, [], "residual", list(RESIDUAL_QUANTILES.values()), list(RESIDUAL_QUANTILES)).first()
    shared = (float(1 - sse / m.co[p, p]), float(np.sqrt(sse / m.n)), *[float(quantiles[q]) for q in RESIDUAL_QUANTILES])
    rows = [(name, *map(float, x), *shared) for name, *x in zip(["(Intercept)", *[t.name for t in m.terms]], estimate, error, t, p_value, strict=True)]
    schema = "term string, estimate double, std_error double, t_value double, p_value double, r2 double, rmse double, " + ", ".join(f"{q} double" for q in RESIDUAL_QUANTILES)
    return df.sparkSession.createDataFrame(rows, schema)


def coefficient_table(df: DataFrame, fits: Mapping[float, Fit]) -> DataFrame:
    """(penalty, term, estimate) of every fit."""
    rows = [(float(x), name, float(v)) for x, f in fits.items() for name, v in zip(["(Intercept)", *[t.name for t in f.terms]], [f.intercept, *f.coefficients], strict=True)]
    return df.sparkSession.createDataFrame(rows, "penalty double, term string, estimate double")
