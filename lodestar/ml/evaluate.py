"""Model evaluation tables.

Everything is a DataFrame computation: AUC by the rank-sum identity over
distinct scores, deciles by the distributed ``ntile``, so no scored table is
brought to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.defaults import SCORE_BINS
from lodestar.operators import rollups, setops, windows


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve, ties counted half (M15), as a one-row DataFrame.

    Mann-Whitney form: (sum of mid-ranks of positives - n1 (n1 + 1) / 2) / (n1 n0).
    Scores are first reduced to (score, positives, count) -- one row per
    distinct score -- and ranks come from a running count over that table.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    per_score = rows.groupBy(score).agg(
        F.count(F.lit(1)).alias("__c"), F.sum((F.col(label) > 0).cast("long")).alias("__p")
    )
    ranked = windows.cumulative_sum(per_score, [F.col(score).asc()], "__c", "__cum")
    ranked = ranked.withColumn("__mid", F.col("__cum") - F.col("__c") + (F.col("__c") + F.lit(1)) / F.lit(2.0))
    sums = ranked.agg(
        F.sum(F.col("__mid") * F.col("__p")).alias("rank_sum"),
        F.sum("__p").alias("n_pos"),
        F.sum(F.col("__c") - F.col("__p")).alias("n_neg"),
    )
    return sums.select(
        F.try_divide(
            F.col("rank_sum") - F.col("n_pos") * (F.col("n_pos") + F.lit(1)) / F.lit(2.0),
            F.col("n_pos") * F.col("n_neg"),
        ).alias("auc"),
        "n_pos",
        "n_neg",
    )


def auc_evaluator(df: DataFrame, score: str, label: str) -> float:
    """Spark ML's ``areaUnderROC`` without down-sampling (``numBins=0``)."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0)
    return ev.evaluate(df.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label)))


def accuracy_at(df: DataFrame, score: str, label: str, cut: float = 0.5) -> DataFrame:
    """Share of rows with ``(score > cut) == label``."""
    hit = ((F.col(score) > F.lit(cut)).cast("int") == F.col(label).cast("int")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def lift_table(df: DataFrame, score: str, label: str, tie_break: str | None = None, bins: int = SCORE_BINS) -> DataFrame:
    """Cumulative share of positives by score decile, highest scores first.

    ``ntile(desc(score))`` is numbered globally (distributed form); per bin the
    positives are summed, turned into shares of all positives and accumulated.
    ``tie_break`` should be a row key: then equal scores are in an order that
    does not depend on the label, and spread over the range partitions.
    """
    order = [F.col(score).desc_nulls_last(), F.col(tie_break or label).asc_nulls_last()]
    tiles = windows.ntile(df.select(score, label, *([tie_break] if tie_break else [])), bins, order, "bin")
    per_bin = rollups.summarize(tiles, "bin", {"count": F.sum(F.col(label).cast("double"))})
    shares = windows.share_of_total(per_bin, "count", "share")
    return windows.cumulative_sum(shares, [F.col("bin")], "share", "prop").drop("share")


def decile_table(
    parts: Mapping[str, DataFrame], prediction: str, actual: str, bins: int = SCORE_BINS
) -> DataFrame:
    """Mean actual and mean prediction by predicted decile, per data part.

    The parts are appended with a tag and numbered in one distributed
    ``ntile`` partitioned by the tag.  Ties in the prediction are broken by
    the actual value, so tied rows that could swap are interchangeable for
    the means.
    """
    tagged = setops.tagged_union({k: v.select(prediction, actual) for k, v in parts.items()}, "data")
    order = [F.col(prediction).desc_nulls_last(), F.col(actual).asc_nulls_last()]
    t = windows.ntile(tagged, bins, order, "decile", by="data")
    return rollups.summarize(
        t, ["data", "decile"], {"n": F.count(F.lit(1)), "mean_actual": F.avg(actual), "mean_pred": F.avg(prediction)}
    )


def residuals(df: DataFrame, actual: str, prediction: str = "prediction", out_col: str = "residual") -> DataFrame:
    """``actual - prediction`` per row (M20); feed to histogram / raster."""
    return df.withColumn(out_col, F.col(actual) - F.col(prediction))


def regression_metrics(df: DataFrame, actual: str, prediction: str = "prediction") -> DataFrame:
    """n, MSE, RMSE, MAE and R² in one pass."""
    err = F.col(actual) - F.col(prediction)
    # R² = 1 - SSE / SST with SST = n * var_pop(actual): one pass, no second scan for the mean
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.avg(err * err), F.var_pop(actual))).alias("r2"),
    )


def confusion(df: DataFrame, label: str, prediction: str = "prediction", classes=None) -> DataFrame:
    """Confusion counts, actual classes as rows and predicted classes as columns."""
    g = df.select(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted"))
    return g.groupBy("actual").pivot("predicted", list(classes) if classes is not None else None).count().fillna(0)
