"""What both vector searches share: clean vectors and the merge of partial results."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def clean(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles) of the vectors without null, NaN or infinite components; null and empty ones go."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select("vec_id", "embedding").where((F.size("embedding") > 0) & F.col("vec_id").isNotNull())
    return rows.where(finite).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(float)


def blocked(vectors: DataFrame, by: list[str], block_rows: int, label: str) -> DataFrame:
    """``vectors`` with ``label``: a number that deals each group of ``by`` into blocks of about ``block_rows``.

    Groups may hold any share of all rows; they are counted first, and a row's block comes from a hash of its id.
    """
    sizes = vectors.groupBy(*by).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block_rows)).alias(f"{label}s"))
    spread = vectors.join(sizes, by)
    return spread.withColumn(label, F.pmod(F.xxhash64("vec_id"), F.col(f"{label}s")))


def merge_best(partial: DataFrame, k: int, score_type: str, once: bool = True) -> DataFrame:
    """The ``k`` best of each query from blockwise results; with ``once`` a candidate found twice counts once, with its best score."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    if once:
        partial = partial.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", F.col("score").cast(score_type))
