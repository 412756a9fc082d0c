"""Does a refit on scored rows keep the signs of the coefficients?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import sign_flag
from tidemark.operators.training import LinearModel


def scored_as_training(scored: DataFrame, target: str, columns: Sequence[str],
                       prediction: str = "predictions") -> DataFrame:
    """Scored rows in the shape of training rows, the prediction as target."""
    return scored.drop(target).withColumnRenamed(prediction, target).select(*columns)


def refit_rows(training: DataFrame, scored: DataFrame, target: str) -> DataFrame:
    """Training rows followed by scored rows."""
    return training.unionByName(scored_as_training(scored, target, training.columns))


def compare_signs(spark: SparkSession, registered: LinearModel, refit: LinearModel) -> DataFrame:
    """Per feature: both coefficients' flags, and whether they agree."""
    if registered.features != refit.features:
        raise ValueError("the models have different features")
    pairs = list(zip(registered.features, registered.coefficients, refit.coefficients))
    flags = spark.createDataFrame(pairs, "feature string, a double, b double").select(
        "feature",
        sign_flag(F.col("a")).alias("registered_flag"),
        sign_flag(F.col("b")).alias("refit_flag"),
    )
    return flags.withColumn("same", F.col("registered_flag") == F.col("refit_flag"))


def is_stable(comparison: DataFrame) -> DataFrame:
    """One row: whether every sign is kept."""
    return comparison.agg(F.bool_and("same").alias("stable"))
