"""Model search and comparison."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from fractions import Fraction

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.ml import models
from lodestar.ml.evaluate import auc
from lodestar.ml.features import formula, training_table
from lodestar.operators import setops
from lodestar.operators.sampling import HASH_BITS, row_hash


def _param_table(spark, maps, metrics, metric_name: str, ascending: bool) -> DataFrame:
    rows = []
    for i, (m, v) in enumerate(zip(maps, metrics)):
        desc = ", ".join(f"{p.name}={val}" for p, val in sorted(m.items(), key=lambda kv: kv[0].name))
        rows.append((i, desc, float(v)))
    df = spark.createDataFrame(rows, f"model int, params string, {metric_name} double")
    return df.orderBy(F.col(metric_name).asc() if ascending else F.col(metric_name).desc())


def penalty_path(train: DataFrame, spec: str, reg_params: Sequence[float], elastic: float = 0.0, train_ratio: float = 0.8, seed: int = 42):
    """Linear model over a penalty path, chosen on a held-out part.
    Returns the fitted search and a table of validation RMSE per penalty."""
    lr = LinearRegression(elasticNetParam=elastic)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).build()
    tvs = TrainValidationSplit(
        estimator=Pipeline(stages=[formula(spec), lr]), estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(metricName="rmse"), trainRatio=train_ratio, seed=seed, parallelism=4,
    ).fit(train)
    return tvs, _param_table(train.sparkSession, grid, tvs.validationMetrics, "rmse", True)


def cross_validated_logistic(train: DataFrame, spec: str, folds: int = 3, reg_params=(0.0, 0.01, 0.1), seed: int = 42):
    """Binomial GLM with k-fold cross-validation; mean AUC per setting."""
    lr = LogisticRegression()
    grid = ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).build()
    cv = CrossValidator(
        estimator=Pipeline(stages=[formula(spec), lr]), estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC"), numFolds=folds, seed=seed, parallelism=4,
    ).fit(train)
    return cv, _param_table(train.sparkSession, grid, cv.avgMetrics, "auc", False)


def _settings(estimator, grid: Mapping[str, Sequence], max_models: int | None, seed: int) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    return random.Random(seed).sample(maps, max_models) if max_models is not None and len(maps) > max_models else maps


def _validated(train: DataFrame, valid: DataFrame, estimator, maps: Sequence[dict], parallelism: int) -> list[float]:
    """Validation MSE of every setting: fits run side by side, all models are scored in one scan of ``valid``."""
    spark = train.sparkSession
    fit = inheritable_thread_target(spark)(lambda pm: estimator.fit(train, pm))
    with ThreadPoolExecutor(parallelism) as pool:
        fitted = list(pool.map(fit, maps))
    scored = valid
    for i, m in enumerate(fitted):
        scored = m.copy({m.getParam("predictionCol"): f"__p{i}"}).transform(scored)
    found = scored.agg(*[F.avg(F.pow(F.col("label") - F.col(f"__p{i}"), 2)) for i in range(len(maps))]).first()
    return [float("nan") if v is None else float(v) for v in found]


def grid_search(train: DataFrame, valid: DataFrame, spec: str, estimator, grid: Mapping[str, Sequence], max_models: int | None = None, seed: int = 42, parallelism: int = 4):
    """Fit every setting of ``grid`` (or a seeded random subset of at most
    ``max_models``) on ``train`` and rank by MSE on ``valid`` (M28, M29).

    Validation uses a separate frame, not the training data.  Both frames are
    encoded and written once; the fits run side by side over the written table
    and all models are scored in one scan.
    """
    maps = _settings(estimator, grid, max_models, seed)
    encoder = formula(spec).fit(train)
    train, valid = (training_table(encoder.transform(x).select("features", "label")) for x in (train, valid))
    return _param_table(train.sparkSession, maps, _validated(train, valid, estimator, maps, parallelism), "mse", True)


def halving_search(
    df: DataFrame, key: Sequence[str] | str, spec: str, estimator, grid: Mapping[str, Sequence], factor: int = 3, valid_share: float = 0.2,
    max_models: int | None = None, seed: int = 42, parallelism: int = 4,
) -> DataFrame:
    """Successive halving over ``grid``: settings are tried on a small sample, the best go on to a larger one.

    Parts are by the portable hash of ``key``: a validation part, and nested
    samples of the rest, each ``factor`` times the one before; the last is the
    whole rest.  Of each round the best 1 / ``factor`` settings go on.  The
    input is read twice (encoder, written table); then each round costs its
    fits over a sample and one scan of the validation part.  Returns model,
    params, round (the last one it was in), share (of the rest), mse, rank: by
    round reached, then by mse.
    """
    maps = _settings(estimator, grid, max_models, seed)
    hashed = df.withColumn("__h", row_hash(key, seed))
    table = training_table(formula(spec).fit(df).transform(hashed).select("features", "label", "__h"))
    cut, whole = round(Fraction(valid_share) * 2**HASH_BITS), 2**HASH_BITS
    valid, rest = table.where(F.col("__h") < cut).drop("__h"), table.where(F.col("__h") >= cut)
    rounds = 1
    while factor ** (rounds - 1) < len(maps):
        rounds += 1
    left, reached = list(range(len(maps))), {}
    for k in range(rounds):
        share = Fraction(1, factor ** (rounds - 1 - k))
        sample = rest.where(F.col("__h") < cut + round((whole - cut) * share)).select("features", "label")
        found = _validated(sample, valid, estimator, [maps[i] for i in left], parallelism)
        order = sorted(zip(found, left, strict=True), key=lambda x: (x[0] != x[0], x))
        reached |= {i: (k + 1, float(share), mse) for mse, i in order}
        left = [i for _, i in order[: -(-len(left) // factor)]]
    ranked = sorted(reached.items(), key=lambda x: (-x[1][0], x[1][2] != x[1][2], x[1][2], x[0]))
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(maps[i].items(), key=lambda kv: kv[0].name)), *at, rank + 1) for rank, (i, at) in enumerate(ranked)]
    return df.sparkSession.createDataFrame(rows, "model int, params string, round int, share double, mse double, rank int")


def compare_regressors(train: DataFrame, test: DataFrame, spec: str, label: str, kinds=("linear", "glm_gaussian", "decision_tree")) -> DataFrame:
    """Train and test MSE per model kind."""
    out = {}
    for kind in kinds:
        m = models.fit_regressor(train, spec, kind)
        tr = m.transform(train).agg(F.avg(F.pow(F.col(label) - F.col("prediction"), 2)).alias("train_mse"))
        te = m.transform(test).agg(F.avg(F.pow(F.col(label) - F.col("prediction"), 2)).alias("test_mse"))
        out[kind] = tr.withColumn("test_mse", te.scalar())
    return setops.tagged_union(out, "model")


def compare_classifiers(
    df: DataFrame, label: str, features: Sequence[str], key: str, train_frac: float = 0.75, seed: int = 42,
    kinds=("logistic", "decision_tree", "random_forest", "gbt", "naive_bayes"),
) -> DataFrame:
    """Refit every classifier on a user-chosen feature set and split; AUC per model
    on the held-out part, from predicted probabilities (M33, M15).  The split is
    a seeded hash of ``key``, so it does not depend on partitioning."""
    from lodestar.operators.verbs import hash_split

    spec = f"{label} ~ " + " + ".join(features)
    parts = hash_split(df, {"train": train_frac, "test": 1 - train_frac}, key, seed)
    train, test = parts["train"], parts["test"]
    out = {}
    for kind in kinds:
        m = models.fit_classifier(train, spec, kind, seed)
        scored = models.positive_probability(m.transform(test))
        out[kind] = auc(scored, "score", label).select("auc")
    return setops.tagged_union(out, "model")
