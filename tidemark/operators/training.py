"""Labels, split, least squares, evaluation and the table of model versions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_percent
from tidemark.sources.readers import read_if_exists, read_table

REGISTRY_SCHEMA = (
    "model string, version int, intercept double, coefficients array<double>, "
    "features array<string>, metrics map<string,double>"
)
# One row per decision on a version, appended; a version without one is registered only.
STAGE_SCHEMA = "model string, version int, stage string, rmse double"
ACCEPTED, REJECTED = "accepted", "rejected"


@dataclass(frozen=True)
class LinearModel:
    """Coefficients in the order of ``features``, and the intercept."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def prediction(self) -> Column:
        """The prediction for a row, as a plain expression over its columns."""
        total = F.lit(float(self.intercept))
        for name, weight in zip(self.features, self.coefficients):
            total = total + F.lit(float(weight)) * F.col(name).cast("double")
        return total


def label_columns(df: DataFrame, keys: Sequence[str], id_col: str, target: str) -> DataFrame:
    """Key and target only, with the id as a long (null if it is no number)."""
    return df.select(*keys, target).withColumn(id_col, F.col(id_col).try_cast("long"))


def in_date_range(df: DataFrame, day_col: str, start=None, end=None, day=None) -> DataFrame:
    """Rows of one ``day``, of an inclusive range, or all of them."""
    if day is not None:
        return df.where(F.col(day_col) == F.lit(day))
    if start is not None:
        df = df.where(F.col(day_col) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(day_col) <= F.lit(end))
    return df


def training_labels(
    historical: DataFrame,
    daily: DataFrame | None,
    keys: Sequence[str],
    id_col: str,
    target: str,
    *,
    mode: str = "all",
    day_col: str = "Date",
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Labels to train on: ``historical``, those plus a ``range`` of daily
    labels, or ``all``."""
    labels = label_columns(historical, keys, id_col, target)
    if mode == "historical":
        return labels
    if mode == "range":
        daily = in_date_range(daily, day_col, start, end)
    elif mode != "all":
        raise ValueError(f"unknown mode {mode!r}")
    return labels.unionByName(label_columns(daily, keys, id_col, target))


def with_split(df: DataFrame, keys: Sequence[str], train_percent: int = 80) -> DataFrame:
    """Mark each row ``train`` or ``test`` by a hash of its key.

    The mark depends on the key alone: it is the same on every run and under
    every partitioning, and rows of one key stay together.
    """
    bucket = hash_percent(*[F.col(k) for k in keys])
    return df.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))


def train_test_split(df: DataFrame, keys: Sequence[str],
                     train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """The two parts of ``with_split``."""
    marked = with_split(df, keys, train_percent)
    return tuple(marked.where(F.col("split") == part).drop("split") for part in ("train", "test"))


def fit_linear(df: DataFrame, features: Sequence[str], target: str) -> LinearModel:
    """Ordinary least squares with intercept; rows with nulls are left out.

    Means and deviations are summed in one pass, correlations by Spark ML; a square in the
    number of features reaches the driver. Features that depend on each other, such as the
    indicators of a category, get the solution of smallest norm.
    """
    columns = [*features, target]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    dense = rows.select(array_to_vector(F.array(*[F.col(f"`{c}`") for c in columns])).alias("v"))
    n, *moments = rows.agg(
        F.count(F.lit(1)), *[F.avg(f"`{c}`") for c in columns],
        *[F.coalesce(F.stddev_samp(f"`{c}`"), F.lit(0.0)) for c in columns]).first()
    if not n:
        raise ValueError("no complete rows to fit")
    means, spread = np.split(np.array(moments), 2)
    scatter = np.zeros((len(columns), len(columns)))
    if n > 1:
        correlation = Correlation.corr(dense, "v").first()[0].toArray()
        # A column that never changes has no correlation, and no share in the fit.
        scatter = np.where(np.outer(spread, spread) > 0, correlation, 0.0) * np.outer(spread, spread)
    weights = smallest_solution(scatter[:-1, :-1], scatter[:-1, -1])
    return LinearModel(tuple(features), tuple(weights.tolist()),
                       float(means[-1] - weights @ means[:-1]))


def smallest_solution(scatter: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """The solution of smallest norm of the normal equations.

    Dependence is judged on the correlation scale, where units do not matter;
    the part along dependent directions is then taken out in the given units.
    """
    spread = np.sqrt(np.diag(scatter))
    spread[spread == 0] = 1.0
    values, vectors = np.linalg.eigh(scatter / np.outer(spread, spread))
    free = values < 1e-10 * max(values[-1], 1.0)
    kept = vectors[:, ~free]
    weights = kept @ ((kept.T @ (cross / spread)) / values[~free]) / spread
    if free.any():
        basis, _ = np.linalg.qr(vectors[:, free] / spread[:, None])
        weights = weights - basis @ (basis.T @ weights)
    return weights


def model_frame(spark: SparkSession, model: LinearModel) -> DataFrame:
    """One row per term of the model."""
    terms = [("(intercept)", model.intercept), *zip(model.features, model.coefficients)]
    return spark.createDataFrame(terms, "term string, coefficient double")


def errors(scored: DataFrame, target: str, prediction: str = "predictions",
           limit: float = 2500.0) -> DataFrame:
    """One row: mean squared error, its root, and whether that is below ``limit``."""
    squared = F.pow(F.col(target).cast("double") - F.col(prediction), F.lit(2.0))
    return scored.agg(F.avg(squared).alias("mse")).select(
        "mse",
        F.sqrt("mse").alias("rmse"),
        (F.sqrt("mse") < limit).alias("accepted"),
    )


def latest_versions(registry: DataFrame) -> DataFrame:
    """Highest version of every model, at least 1."""
    return registry.groupBy("model").agg(
        F.greatest(F.lit(1), F.max("version")).cast("int").alias("version"))


def next_version(spark: SparkSession, path: str, name: str) -> int:
    """The version a new model of this name gets."""
    registry = read_if_exists(spark, path)
    if registry is None:
        return 1
    top = latest_versions(registry.where(F.col("model") == name)).collect()
    return top[0]["version"] + 1 if top else 1


def register_model(spark: SparkSession, path: str, name: str, model: LinearModel,
                   metrics: dict[str, float] | None = None) -> int:
    """Append a new version of ``name`` to the table of models; one writer at a time."""
    version = next_version(spark, path, name)
    row = (name, version, model.intercept, list(model.coefficients), list(model.features),
           metrics or {})
    spark.createDataFrame([row], REGISTRY_SCHEMA).write.mode("append").parquet(path)
    return version


def load_latest(spark: SparkSession, path: str, name: str) -> LinearModel:
    """The model with the highest version of this name."""
    registry = read_table(spark, path).where(F.col("model") == name)
    newest = registry.join(latest_versions(registry), on=["model", "version"]).collect()
    if not newest:
        raise LookupError(f"no model named {name}")
    row = newest[0]
    return LinearModel(tuple(row["features"]), tuple(row["coefficients"]), row["intercept"])


def load_version(spark: SparkSession, path: str, name: str, version: int) -> LinearModel:
    """One version of a model."""
    rows = read_table(spark, path).where((F.col("model") == name) & (F.col("version") == version)).collect()
    if not rows:
        raise LookupError(f"no version {version} of {name}")
    return LinearModel(tuple(rows[0]["features"]), tuple(rows[0]["coefficients"]), rows[0]["intercept"])


def decide_stage(spark: SparkSession, path: str, name: str, version: int, accepted: bool, rmse: float | None) -> str:
    """Record that a registered version is accepted or rejected; it is decided once only."""
    decided = read_if_exists(spark, path)
    if decided is not None and not decided.where((F.col("model") == name) & (F.col("version") == version)).isEmpty():
        raise ValueError(f"version {version} of {name} has been decided before")
    stage = ACCEPTED if accepted else REJECTED
    spark.createDataFrame([(name, version, stage, rmse)], STAGE_SCHEMA).write.mode("append").parquet(path)
    return stage


def load_accepted(spark: SparkSession, path: str, stages_path: str, name: str) -> LinearModel:
    """The highest version that validation has accepted."""
    stages = read_if_exists(spark, stages_path)
    top = None if stages is None else stages.where((F.col("model") == name) & (F.col("stage") == ACCEPTED)).agg(F.max("version")).first()[0]
    if top is None:
        raise LookupError(f"no accepted version of {name}")
    return load_version(spark, path, name, top)
