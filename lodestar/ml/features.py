"""Feature engineering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Bucketizer, Imputer, RFormula, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucketize(df: DataFrame, col: str, splits: Sequence[float], out_col: str, handle_invalid: str = "keep") -> DataFrame:
    """``Bucketizer``: left-closed bins, last bin closed.

    ``handle_invalid="keep"`` puts NULL/NaN and out-of-range values in an
    extra bucket instead of raising; ``"error"`` is Spark's default.
    """
    b = Bucketizer(splits=list(splits), inputCol=col, outputCol=out_col, handleInvalid=handle_invalid)
    return b.transform(df)


def formula(spec: str, base: str = "alphabetDesc", handle_invalid: str = "error") -> RFormula:
    """``y ~ a + b`` encoder: numeric pass-through, strings one-hot with one level dropped.

    ``stringIndexerOrderType="alphabetDesc"`` fixes the dropped base level to
    the alphabetically first value, independent of the data's frequencies.
    ``handle_invalid="keep"`` gives unseen levels their own (all-zero in
    training) column, which suits trees but makes least squares singular, so
    the default is ``"error"``.
    """
    return RFormula(formula=spec, stringIndexerOrderType=base, handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: Sequence[str], out_col: str = "features") -> DataFrame:
    """Numeric columns to one vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out_col, handleInvalid="skip").transform(df)


def array_features(df: DataFrame, array_col: str, out_col: str = "features") -> DataFrame:
    """Array<float> column to an ML vector (embeddings)."""
    return df.withColumn(out_col, array_to_vector(F.col(array_col)))


def prepare_pipeline(
    impute_cols: Sequence[str], bucket_col: str, splits: Sequence[float], bucket_out: str
) -> Pipeline:
    """Mean imputation then bucketing as one reusable ``Pipeline``."""
    return Pipeline(
        stages=[
            Imputer(inputCols=list(impute_cols), outputCols=list(impute_cols), strategy="mean"),
            Bucketizer(splits=list(splits), inputCol=bucket_col, outputCol=bucket_out, handleInvalid="keep"),
        ]
    )


def training_table(df: DataFrame) -> DataFrame:
    """Materialise a model's input once in the shared checkpoint folder.

    Fits read their input several times (encoder fit, solver passes,
    summary); a checkpoint computes the upstream joins once and survives the
    loss of an executor.  The rows are rebalanced to partitions of even size
    first, so the solver passes run in parallel.
    """
    from lodestar.session import reliable_checkpoint

    return reliable_checkpoint(df.hint("rebalance"))
