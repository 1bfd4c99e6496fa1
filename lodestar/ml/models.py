"""Fits and model tables.

A model is ``Pipeline([RFormula, estimator])`` fitted on a DataFrame; the
tidy tables (coefficients, importances, centres) are built from the fitted
model's per-feature values, which are small by construction.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.defaults import BOOSTING_DEPTH, BOOSTING_ROUNDS
from lodestar.ml.features import formula

CLASSIFIERS = {
    "logistic": lambda seed: LogisticRegression(),
    "decision_tree": lambda seed: DecisionTreeClassifier(seed=seed),
    "random_forest": lambda seed: RandomForestClassifier(seed=seed),
    "gbt": lambda seed: GBTClassifier(seed=seed),
    "naive_bayes": lambda seed: NaiveBayes(modelType="gaussian"),
}
REGRESSORS = {
    "linear": lambda seed: LinearRegression(solver="normal"),
    "decision_tree": lambda seed: DecisionTreeRegressor(seed=seed),
    "random_forest": lambda seed: RandomForestRegressor(seed=seed),
    "gbt": lambda seed: GBTRegressor(seed=seed),
    "glm_gaussian": lambda seed: GeneralizedLinearRegression(family="gaussian", link="identity", regParam=0.0),
}


def fit_formula(df: DataFrame, spec: str, estimator, handle_invalid: str = "error") -> PipelineModel:
    """Fit ``estimator`` on the formula-encoded ``df``."""
    return Pipeline(stages=[formula(spec, handle_invalid=handle_invalid), estimator]).fit(df)


def fit_classifier(df: DataFrame, spec: str, kind: str, seed: int = 42) -> PipelineModel:
    """One of logistic, decision_tree, random_forest, gbt, naive_bayes.
    Unseen levels at scoring time get their own column instead of failing."""
    return fit_formula(df, spec, CLASSIFIERS[kind](seed), handle_invalid="keep")


def fit_regressor(df: DataFrame, spec: str, kind: str = "linear", seed: int = 42) -> PipelineModel:
    """One of linear, decision_tree, random_forest, gbt, glm_gaussian."""
    return fit_formula(df, spec, REGRESSORS[kind](seed))


def encoded_width(df: DataFrame, spec: str) -> int:
    """Width of the encoded feature vector of ``spec`` on ``df`` (from metadata, no scan of rows)."""
    enc = formula(spec, handle_invalid="keep").fit(df)
    meta = enc.transform(df.limit(0)).schema["features"].metadata
    attrs = meta.get("ml_attr", {}).get("attrs", {})
    return sum(len(v) for v in attrs.values())


def fit_perceptron(df: DataFrame, spec: str, hidden=(15,), n_classes: int = 2, seed: int = 42) -> PipelineModel:
    """Multilayer perceptron whose first layer is the encoded width."""
    layers = [encoded_width(df, spec), *hidden, n_classes]
    return fit_formula(df, spec, MultilayerPerceptronClassifier(layers=layers, seed=seed, maxIter=100), "keep")


def score(model: PipelineModel, df: DataFrame, one_based_cluster: bool = False) -> DataFrame:
    """Append predictions (M14); k-means labels optionally shifted to 1-based."""
    out = model.transform(df)
    if one_based_cluster:
        out = out.withColumn("prediction", F.col("prediction") + 1)
    return out


def positive_probability(scored: DataFrame, out_col: str = "score") -> DataFrame:
    """Probability of class 1 from a classifier's ``probability`` vector."""
    from pyspark.ml.functions import vector_to_array

    return scored.withColumn(out_col, vector_to_array("probability")[1])


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the encoded features, in vector order (from the column metadata)."""
    meta = model.stages[0].transform(df.limit(0)).schema["features"].metadata
    attrs = meta.get("ml_attr", {}).get("attrs", {})
    pairs = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    return [n for _, n in sorted(pairs)]


def linear_summary(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Tidy coefficient table with standard errors, t and p values, plus R² and RMSE."""
    lr = model.stages[-1]
    s = lr.summary
    names = ["(Intercept)", *feature_names(model, df)] if lr.getFitIntercept() else feature_names(model, df)
    coefs = list(lr.coefficients)
    est = [lr.intercept, *coefs] if lr.getFitIntercept() else coefs
    # Spark lists standard errors / t / p with the intercept last
    def reorder(xs):
        xs = list(xs)
        return [xs[-1], *xs[:-1]] if lr.getFitIntercept() else xs

    se, tv, pv = reorder(s.coefficientStandardErrors), reorder(s.tValues), reorder(s.pValues)
    rows = [(n, float(e), float(a), float(b), float(c)) for n, e, a, b, c in zip(names, est, se, tv, pv)]
    spark = df.sparkSession
    schema = "term string, estimate double, std_error double, t_value double, p_value double"
    table = spark.createDataFrame(rows, schema)
    return table.withColumns({"r2": F.lit(float(s.r2)), "rmse": F.lit(float(s.rootMeanSquaredError))})


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Named feature importances of a tree model, largest first."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(feature_names(model, df), imp)]
    out = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return out.orderBy(F.desc("importance"))


def kmeans(df: DataFrame, features: str, k: int, seed: int = 42):
    """K-means on a vector column."""
    return KMeans(featuresCol=features, k=k, seed=seed).fit(df)


def cluster_stats(model, df: DataFrame, features: str) -> DataFrame:
    """Per cluster: size and within-cluster sum of squares, with the centre.

    The centres (k rows) join the assigned rows; distances are Column math on
    the vector as array, aggregated per cluster.
    """
    from pyspark.ml.functions import vector_to_array

    spark = df.sparkSession
    centres = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        T.StructType([T.StructField("prediction", T.IntegerType()), T.StructField("centre", T.ArrayType(T.DoubleType()))]),
    )
    scored = model.transform(df).select("prediction", vector_to_array(features).alias("__v"))
    joined = scored.join(F.broadcast(centres), "prediction")
    sq = F.aggregate(
        F.zip_with("__v", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x
    )
    return joined.groupBy("prediction", "centre").agg(
        F.count(F.lit(1)).alias("size"), F.sum(sq).alias("within_ss")
    )


def pca(df: DataFrame, features: str, k: int):
    """Principal components and explained variance."""
    model = PCA(k=k, inputCol=features, outputCol="pca").fit(df)
    var = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    table = df.sparkSession.createDataFrame(var, "component int, explained_variance double")
    return model, table


def gaussian_bayes(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Gaussian naive Bayes as a table: class, feature, mean, variance and log prior.

    Rows with a null in a column or the label are left out; labels are 0, 1, ...
    """
    known = df.dropna(subset=[*columns, label])
    vectors = VectorAssembler(inputCols=columns, outputCol="__x").transform(known)
    model = NaiveBayes(featuresCol="__x", labelCol=label, modelType="gaussian").fit(vectors)
    theta, sigma, prior = model.theta.toArray(), model.sigma.toArray(), model.pi.toArray()
    rows = [(c, f, float(theta[c, i]), float(sigma[c, i]), float(prior[c])) for c in range(len(prior)) for i, f in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "class long, feature string, mean double, variance double, log_prior double")


def one_vs_rest_gbt(
    df: DataFrame, features: str, label: str, step: float = 0.1, col_rate: str = "0.7", seed: int = 42,
    rounds: int = BOOSTING_ROUNDS, depth: int = BOOSTING_DEPTH,
):
    """Multi-class boosted trees: one binary GBT per class."""
    gbt = GBTClassifier(stepSize=step, featureSubsetStrategy=col_rate, seed=seed, maxIter=rounds, maxDepth=depth)
    return OneVsRest(classifier=gbt, featuresCol=features, labelCol=label).fit(df)


def save(model, path: str) -> None:
    """Persist a fitted model, replacing what is there."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
