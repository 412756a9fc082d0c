"""A registry of categories, which only grows: it fixes the indicator columns of every increment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.features import MAX_CATEGORIES, clean_name
from tidemark.sources.readers import read_if_exists

SCHEMA = "column string, position int, value string"


def registered(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values registered for ``column``, in the order they came."""
    table = read_if_exists(spark, path)
    if table is None:
        return []
    rows = table.where(F.col("column") == column).orderBy("position")
    return [r.value for r in rows.select("value").collect()]  # as many as there are indicator columns


def register(df: DataFrame, column: str, path: str, limit: int = MAX_CATEGORIES) -> list[str]:
    """All values registered for ``column``, those that ``df`` adds being recorded first, in sorted order.

    Positions never change, so a value keeps its column for good, whichever increments hold it. Null is
    no category. More than ``limit`` values in all are refused, as are two that would name the same column.
    One writer per registry.
    """
    spark = df.sparkSession
    known = registered(spark, path, column)
    values = df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct()
    if known:
        values = values.where(~F.col("value").isin(known))
    added = sorted(r.value for r in values.limit(limit + 1).collect())
    every = [*known, *added]
    if len(every) > limit:
        raise ValueError(f"{column} has more than {limit} values")
    names = indicator_names(every)
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns collide after renaming: {twice}")
    if added:
        rows = [(column, len(known) + i, v) for i, v in enumerate(added)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return every


def indicator_names(values: Sequence[str]) -> list[str]:
    """Columns that hold the indicators of ``values``."""
    return [clean_name(str(v)) for v in values]


def with_all_indicators(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """``df`` with 0 in the indicators of categories registered after its rows were built."""
    names = indicator_names(values)
    out = df.withColumns({n: F.lit(0) for n in names if n not in df.columns})
    return out.fillna(0, subset=names) if names else out
