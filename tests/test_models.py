"""Model tests: closed forms, seeds, persistence."""

import pytest
from pyspark.sql import functions as F

from lodestar.ml import evaluate, models
from lodestar.plans import standins as si
from tests.conftest import SF_SMALL


def test_ols_matches_closed_form(spark):
    t = si.trips(spark, SF_SMALL).select("fare_amount", "trip_distance")
    m = models.fit_regressor(t, "fare_amount ~ trip_distance", "linear")
    ref = t.agg(F.regr_slope("fare_amount", "trip_distance").alias("b"), F.regr_intercept("fare_amount", "trip_distance").alias("a")).first()
    lr = m.stages[-1]
    assert lr.coefficients[0] == pytest.approx(ref["b"], rel=1e-9)
    assert lr.intercept == pytest.approx(ref["a"], rel=1e-9)


def test_glm_equals_ols(spark):
    g = si.flights(spark, SF_SMALL).withColumn("gain", F.col("depdelay") - F.col("arrdelay"))
    a = models.fit_regressor(g, "gain ~ depdelay + distance", "linear").stages[-1]
    b = models.fit_regressor(g, "gain ~ depdelay + distance", "glm_gaussian").stages[-1]
    assert list(a.coefficients) == pytest.approx(list(b.coefficients), rel=1e-6)


def test_linear_summary_table(spark):
    g = si.flights(spark, SF_SMALL).withColumn("gain", F.col("depdelay") - F.col("arrdelay"))
    m = models.fit_regressor(g, "gain ~ depdelay + uniquecarrier", "linear")
    tab = models.linear_summary(m, g)
    rows = {r["term"]: r for r in tab.collect()}
    assert "(Intercept)" in rows and "depdelay" in rows
    assert all(r["std_error"] > 0 for r in rows.values())


def test_fixed_seed_and_reload(spark, scratch_dir):
    lab = si.titanic(spark, SF_SMALL).where(F.col("label").isNotNull())
    a = models.fit_classifier(lab, "label ~ n_chars + lang", "random_forest", seed=5)
    b = models.fit_classifier(lab, "label ~ n_chars + lang", "random_forest", seed=5)
    pa = [r[0] for r in a.transform(lab).select("prediction").collect()]
    assert pa == [r[0] for r in b.transform(lab).select("prediction").collect()]
    models.save(a, scratch_dir + "/rf")
    again = models.load(scratch_dir + "/rf")
    assert pa == [r[0] for r in again.transform(lab).select("prediction").collect()]


def test_auc_rank_sum_vs_evaluator_on_documents(spark):
    lab = si.titanic(spark, SF_SMALL).where(F.col("label").isNotNull())
    a = evaluate.auc(lab, "n_chars", "label").first()["auc"]
    assert a == pytest.approx(evaluate.auc_evaluator(lab, "n_chars", "label"), abs=1e-12)


def test_gaussian_bayes_leaves_out_nulls(spark):
    rows = [(0.0, 1.0), (0.0, 3.0), (1.0, 10.0), (1.0, None), (None, 5.0)]
    tab = models.gaussian_bayes(spark.createDataFrame(rows, "y double, x double"), ["x"], "y").orderBy("class").collect()
    assert [(r["class"], r["feature"], r["mean"]) for r in tab] == [(0, "x", 2.0), (1, "x", 10.0)]
    assert tab[0]["variance"] == pytest.approx(1.0, abs=1e-6)
