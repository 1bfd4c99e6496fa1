"""Cross-validated logistic regression with one scan per Newton step, whatever the number of folds and penalties.

Every step is one aggregation over the encoded table: each partition sums loss,
gradient and curvature of all models (fold left out, penalty) at once, and the
sums are added up by position.  The driver holds models * terms^2 numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.ml import gram
from lodestar.ml.features import training_table
from lodestar.operators import sampling
from lodestar.operators.windows import ahead_counts


@dataclass(frozen=True)
class Model:
    """A fit without the rows of ``fold`` (None: with all rows)."""

    fold: int | None
    penalty: float
    intercept: float
    coefficients: np.ndarray  # of the raw terms


def _encoded(df: DataFrame, label: str, m: gram.Moments, scale: np.ndarray, fold) -> DataFrame:
    """(x, y, fold): the terms about their mean in units of ``scale``; rows with a null in a used column are left out."""
    columns = list(dict.fromkeys([t.column for t in m.terms] + [label]))
    complete = df.withColumn("__fold", fold).dropna(subset=[f"`{c}`" for c in columns])
    x = [(t.value() - F.lit(float(mean))) / F.lit(float(s)) for t, mean, s in zip(m.terms, m.mean, scale)]
    return complete.select(F.array(*x).alias("x"), (F.col(f"`{label}`") > 0).cast("double").alias("y"), F.col("__fold").alias("fold"))


def _sums(table: DataFrame, at: np.ndarray, left_out: np.ndarray) -> np.ndarray:
    """For each model: loss, gradient and curvature summed over the rows not in its fold; one scan."""
    models, width = at.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((models, 1 + width + width * width))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = np.ones((n, width))
            x[:, 1:] = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, width - 1)
            y = batch.column("y").to_numpy(zero_copy_only=False)[:, None]
            used = batch.column("fold").to_numpy(zero_copy_only=False)[:, None] != left_out[None, :]
            eta = x @ at.T
            p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
            total[:, 0] += ((np.logaddexp(0, eta) - y * eta) * used).sum(0)
            total[:, 1 : 1 + width] += ((p - y) * used).T @ x
            weight = p * (1 - p) * used
            for k in range(models):
                total[k, 1 + width :] += (x.T @ (x * weight[:, k : k + 1])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    parts = table.mapInArrow(run, "sums array<double>")
    rows = parts.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(models * (1 + width + width * width))
    for r in rows:
        out[r["i"]] = r["v"]
    return out.reshape(models, -1)


def fit_folds(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], penalties: Sequence[float], folds: int, key: Sequence[str] | str, seed: int = 42, steps: int = 50, tol: float = 1e-9
) -> tuple[list[Model], DataFrame, np.ndarray, gram.Moments]:
    """A model per fold left out and penalty, the encoded table, its scale and moments.

    Each model minimises the mean log loss plus penalty / 2 times the squares
    of its coefficients in units of the terms' sample deviation in its own
    rows; the intercept bears no penalty.  Steps that raise the loss are
    halved, each model's on its own.  Fold of a row: the portable hash of
    ``key`` modulo ``folds``.
    """
    fold = sampling.fold_of(key, folds, seed)
    parts = gram.moments(df, label, numeric, categorical, fold)
    whole = gram.total(parts.values())
    p = len(whole.terms)
    spread = np.sqrt(np.maximum(np.diag(whole.co)[:p], 0) / max(1.0, whole.n))
    used = spread > 1e-12 * np.maximum(1.0, np.abs(whole.mean[:p]))
    scale = np.where(used, spread, 1.0)
    table = training_table(_encoded(df, label, whole, scale, fold))

    names = [(k, float(x)) for k in sorted(parts) for x in penalties]
    left_out = np.array([k for k, _ in names], np.int64)
    n = np.array([(whole - parts[k]).n for k, _ in names])
    ridge = np.zeros((len(names), p + 1))
    for i, (k, penalty) in enumerate(names):
        rest = whole - parts[k]
        ridge[i, 1:] = penalty * np.maximum(np.diag(rest.co)[:p], 0) / max(1.0, rest.n - 1) / scale**2
    now, step = np.zeros((len(names), p + 1)), np.zeros((len(names), p + 1))
    loss, size = np.full(len(names), np.inf), np.ones(len(names))
    trial = now.copy()
    open_models = np.ones(len(names), bool)
    for _ in range(steps):
        active = np.flatnonzero(open_models)
        if not len(active):
            break
        sums = _sums(table, trial[active], left_out[active])
        for row, i in zip(sums, active, strict=True):
            b = trial[i]
            value = row[0] / n[i] + 0.5 * (ridge[i] * b * b).sum()
            if value > loss[i] + 1e-12 * max(1.0, abs(loss[i])) and size[i] > 1e-6:
                size[i] /= 2  # the step went too far: half of it
                trial[i] = now[i] + size[i] * step[i]
                continue
            now[i], loss[i], size[i] = b, value, 1.0
            slope = row[1 : p + 2] / n[i] + ridge[i] * b
            curve = row[p + 2 :].reshape(p + 1, p + 1) / n[i] + np.diag(ridge[i])
            step[i] = -np.linalg.lstsq(curve, slope, rcond=1e-12)[0]
            trial[i] = now[i] + step[i]
            open_models[i] = np.abs(step[i]).max() > tol * max(1.0, np.abs(b).max())
    raw = now[:, 1:] / scale
    models = [Model(k, x, float(now[i, 0] - raw[i] @ whole.mean[:p]), raw[i]) for i, (k, x) in enumerate(names)]
    return models, table, scale, whole


def auc_by(scored: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """(keys, n, auc) by counts of smaller scores over range partitions; ties count half, null without both classes."""
    counts = scored.groupBy(*keys, score).agg(F.sum(F.col(label)).cast("long").alias("pos"), F.sum(1 - F.col(label)).cast("long").alias("neg"))
    below = ahead_counts(counts, keys, score, "neg", descending=False, out_col="below")
    pos, neg = F.sum("pos"), F.sum("neg")
    return below.groupBy(*keys).agg((pos + neg).alias("n"), F.try_divide(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)), pos * neg).alias("auc"))


def cross_validate(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], penalties: Sequence[float], folds: int, key: Sequence[str] | str, seed: int = 42
) -> DataFrame:
    """(penalty, fold, n, auc) of each fold, scored by the models that did not see it.

    Scans: one for the moments, one that writes the encoded table, one per
    Newton step and one to score; folds and penalties add none.
    """
    models, table, scale, whole = fit_folds(df, label, numeric, categorical, penalties, folds, key, seed)
    p = len(whole.terms)

    def score_of(m: Model):
        parts = [F.lit(m.intercept + float(m.coefficients @ whole.mean[:p]))]
        parts += [F.lit(float(c * s)) * F.get("x", F.lit(i)) for i, (c, s) in enumerate(zip(m.coefficients, scale, strict=True))]
        total = parts[0]
        for part in parts[1:]:
            total = total + part
        return F.struct(F.lit(m.penalty).alias("penalty"), F.lit(m.fold).alias("of"), total.alias("score"))

    scored = table.select("y", "fold", F.explode(F.array(*[score_of(m) for m in models])).alias("s")).where("s.of = fold")
    return auc_by(scored.select("y", "fold", "s.penalty", "s.score"), ["penalty", "fold"], "score", "y").select("penalty", "fold", "n", "auc")
