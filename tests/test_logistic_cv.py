"""Cross-validated logistic regression against fold-by-fold fits of Spark ML."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lodestar.ml import evaluate, logistic_cv
from lodestar.operators import sampling


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    n = 1200
    x1, x2, kind = rng.normal(50, 9, n), rng.exponential(1, n), rng.choice(["a", "b", "c"], n)
    eta = 0.1 * (x1 - 50) - x2 + (kind == "c") + 0.3
    y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(int)
    rows = [(i, float(round(a, 1)), float(b), str(c), int(d)) for i, (a, b, c, d) in enumerate(zip(x1, x2, kind, y))]
    rows.append((n, None, 1.0, "a", 1))
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, kind string, y int").repartition(3)


def test_folds_equal_single_fits(data, monkeypatch):
    scans = []
    whole = logistic_cv._sums
    monkeypatch.setattr(logistic_cv, "_sums", lambda *a: scans.append(1) or whole(*a))
    penalties = [0.0, 0.05, 1.0]
    models, *_ = logistic_cv.fit_folds(data, "y", ["x1", "x2"], ["kind"], penalties, 3, "id")
    assert len(models) == 9 and len(scans) <= 10
    table = {(r.penalty, r.fold): r for r in logistic_cv.cross_validate(data, "y", ["x1", "x2"], ["kind"], penalties, 3, "id").collect()}
    terms = F.array("x1", "x2", (F.col("kind") == "b").cast("double"), (F.col("kind") == "c").cast("double"))
    encoded = data.dropna().select(array_to_vector(terms).alias("features"), F.col("y").cast("double").alias("label"), sampling.fold_of("id", 3).alias("fold")).cache()
    for m in models:
        if m.fold == 1:
            continue
        want = LogisticRegression(regParam=m.penalty, tol=1e-12, maxIter=500).fit(encoded.where(F.col("fold") != m.fold))
        assert m.coefficients == pytest.approx(want.coefficients.toArray(), rel=1e-4, abs=1e-6)
        assert m.intercept == pytest.approx(want.intercept, rel=1e-4)
        held = want.transform(encoded.where(F.col("fold") == m.fold))
        auc = evaluate.auc_evaluator(held.select("label", vector_to_array("rawPrediction")[1].alias("score")), "score", "label")
        r = table[m.penalty, m.fold]
        assert r.auc == pytest.approx(auc, abs=1e-6) and r.n == held.count()


def test_separable_data_does_not_run_away(spark):
    df = spark.createDataFrame([(i, float(i), int(i >= 20)) for i in range(40)], "id long, x double, y int")
    table = logistic_cv.cross_validate(df, "y", ["x"], [], [0.0, 0.1], 2, "id").collect()
    assert len(table) == 4 and all(r.auc == pytest.approx(1.0) for r in table)


def test_auc_by_counts_ties_half(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 0), ("a", 2.0, 1), ("b", 1.0, 0), ("b", 3.0, 0)], "g string, s double, y int")
    got = {r.g: (r.n, r.auc) for r in logistic_cv.auc_by(df, ["g"], "s", "y").collect()}
    assert got == {"a": (3, 0.75), "b": (2, None)}
