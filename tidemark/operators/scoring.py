"""Batch scoring: the prediction is one more column of the row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.training import LinearModel, in_date_range


def score(features: DataFrame, model: LinearModel, output: str = "predictions") -> DataFrame:
    """All columns of ``features`` and the prediction; a row is never moved."""
    return features.withColumn(output, model.prediction())


def score_days(features: DataFrame, model: LinearModel, day_col: str = "Date", *,
               day=None, start=None, end=None) -> DataFrame:
    """Score the feature rows of one day or of an inclusive range."""
    return score(in_date_range(features, day_col, start, end, day), model)
