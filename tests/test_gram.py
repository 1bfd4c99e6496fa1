"""Least squares from moments against numpy and Spark ML."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.ml import gram, models

RNG = np.random.default_rng(3)
N = 900


@pytest.fixture(scope="module")
def data(spark):
    x1, x2 = RNG.normal(1e4, 3, N), RNG.exponential(2, N)
    kind = RNG.choice(["a", "b", "c"], N, p=[0.34, 0.33, 0.33])
    y = 3 + 0.5 * x1 - 2 * x2 + np.where(kind == "b", 4, 0) + RNG.normal(0, 1, N)
    fold = RNG.integers(0, 4, N)
    rows = [(float(a), float(b), str(c), float(d), int(e)) for a, b, c, d, e in zip(x1, x2, kind, y, fold)]
    return spark.createDataFrame(rows, "x1 double, x2 double, kind string, y double, fold int").repartition(3), rows


def matrix(rows):
    x = np.array([[r[0], r[1], r[2] == "b", r[2] == "c"] for r in rows], float)
    return x, np.array([r[3] for r in rows])


def ridge(x, y, penalty):
    mean, sd = x.mean(0), x.std(0)
    z = (x - mean) / sd
    b = np.linalg.solve(z.T @ z / len(y) + penalty * np.eye(x.shape[1]), z.T @ (y - y.mean()) / len(y)) / sd
    return y.mean() - b @ mean, b


def test_moments_merge_and_subtract(data):
    df, rows = data
    whole = gram.moments(df, "y", ["x1", "x2"], ["kind"])[None]
    parts = gram.moments(df, "y", ["x1", "x2"], ["kind"], F.col("fold"))
    x, y = matrix(rows)
    z = np.column_stack([x, y])
    assert [t.name for t in whole.terms] == ["x1", "x2", "kind_b", "kind_c"]
    assert np.allclose(whole.co, (z - z.mean(0)).T @ (z - z.mean(0)), rtol=1e-9) and np.allclose(whole.mean, z.mean(0))
    assert np.allclose(gram.total(parts.values()).co, whole.co, rtol=1e-9)
    left = np.array([r[4] != 2 for r in rows])
    assert np.allclose((whole - parts[2]).co, (z[left] - z[left].mean(0)).T @ (z[left] - z[left].mean(0)), rtol=1e-8)


def test_summary_equals_spark_ml_and_has_residual_quantiles(data):
    df, rows = data
    got = {r.term: r for r in gram.linear_summary(df, "y", ["x1", "x2"], ["kind"]).collect()}
    model = models.fit_regressor(df, "y ~ x1 + x2 + kind", "linear")
    want = {r.term: r for r in models.linear_summary(model, df).collect()}
    assert got.keys() == want.keys()
    for term, r in want.items():
        for field in ("estimate", "std_error", "t_value", "p_value", "r2", "rmse"):
            assert got[term][field] == pytest.approx(r[field], rel=1e-5, abs=1e-9)
    x, y = matrix(rows)
    design = np.column_stack([np.ones(N), x])
    residual = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
    r = got["x1"]
    assert [r.res_min, r.res_q1, r.res_median, r.res_q3, r.res_max] == pytest.approx(np.quantile(residual, [0, 0.25, 0.5, 0.75, 1]), abs=1e-6)


def test_ridge_path_and_errors(data):
    df, rows = data
    penalties = list(np.geomspace(1e-3, 10, 50))
    fits, table = gram.penalty_path(df, "y", ["x1", "x2"], ["kind"], penalties, F.col("fold") == 0)
    train, valid = [r for r in rows if r[4]], [r for r in rows if not r[4]]
    x, y = matrix(train)
    xv, yv = matrix(valid)
    found = {r.penalty: r for r in table.collect()}
    for penalty in penalties[::7]:
        a, b = ridge(x, y, penalty)
        assert fits[penalty].intercept == pytest.approx(a, rel=1e-7) and fits[penalty].coefficients == pytest.approx(b, rel=1e-6, abs=1e-9)
        assert found[penalty].rmse == pytest.approx(np.sqrt(np.mean((yv - a - xv @ b) ** 2)), rel=1e-6)
        assert found[penalty].train_rmse == pytest.approx(np.sqrt(np.mean((y - a - x @ b) ** 2)), rel=1e-6)
    assert [r.rmse for r in table.collect()] == sorted(r.rmse for r in found.values())


def test_path_scans_once(data, monkeypatch):
    df, _ = data
    calls = []
    whole = gram.moments
    monkeypatch.setattr(gram, "moments", lambda *a, **k: calls.append(1) or whole(*a, **k))
    gram.penalty_path(df, "y", ["x1", "x2"], ["kind"], np.geomspace(1e-3, 1, 50), F.col("fold") == 0, 0.5)
    gram.cross_validate(df, "y", ["x1", "x2"], ["kind"], [0.0, 0.1, 1.0], F.col("fold"))
    assert len(calls) == 2


@pytest.mark.parametrize("elastic", [0.3, 1.0])
def test_coordinate_descent_meets_the_optimality_conditions_from_any_start(data, elastic):
    m = gram.moments(data[0], "y", ["x1", "x2"], ["kind"])[None]
    p = len(m.terms)
    sd = np.sqrt(np.diag(m.co)[:p] / m.n)
    for penalty in (0.01, 0.2, 1.0, 50.0):
        cold, warm = gram.solve(m, penalty, elastic), gram.solve(m, penalty, elastic, start=np.array([9.0, -9.0, 1.0, 0.0]))
        assert cold.coefficients == pytest.approx(warm.coefficients, abs=1e-8)
        b = cold.coefficients * sd
        slope = (m.co[:p, p] - m.co[:p, :p] @ cold.coefficients) / m.n / sd - penalty * (1 - elastic) * b
        assert np.allclose(slope[b != 0], penalty * elastic * np.sign(b[b != 0]), atol=1e-8)
        assert (np.abs(slope[b == 0]) <= penalty * elastic + 1e-8).all()
    assert not gram.solve(m, 50.0, 1.0).coefficients.any()


def test_cross_validation_equals_fold_by_fold_fits(data):
    df, rows = data
    table = gram.cross_validate(df, "y", ["x1", "x2"], ["kind"], [0.0, 0.1, 1.0], F.col("fold"))
    assert table.count() == 12
    for r in table.collect():
        x, y = matrix([q for q in rows if q[4] != r.fold])
        xv, yv = matrix([q for q in rows if q[4] == r.fold])
        a, b = ridge(x, y, r.penalty)
        assert r.n == len(yv) and r.rmse == pytest.approx(np.sqrt(np.mean((yv - a - xv @ b) ** 2)), rel=1e-6)


def test_nulls_constants_and_dependent_terms(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 5.0, 3.0 * i + 1, "z") for i in range(20)] + [(None, 1.0, 5.0, 1.0, "z"), (1.0, 1.0, 5.0, 1.0, None)], "a double, b double, c double, y double, `k.1` string")
    m = gram.moments(df, "y", ["a", "c"], ["k.1"])[None]
    fit = gram.solve(m)
    assert m.n == 20 and fit.intercept == pytest.approx(1) and fit.coefficients == pytest.approx([3, 0])
    with pytest.raises(ValueError, match="dependent"):
        gram.linear_summary(df.where("`k.1` = 'z'"), "y", ["a", "b"])
    with pytest.raises(ValueError, match="combinations"):
        gram.moments(df, "y", ["a"], ["b"], max_groups=5)
