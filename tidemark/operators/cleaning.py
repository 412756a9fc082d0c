"""Row and column cleaning between the raw and the enriched layer."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """Rows and nulls of every column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    lines = [
        F.struct(F.lit(c).alias("column"), F.col("rows").alias("n_rows"),
                 F.col(f"n{i}").alias("n_null"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*lines)))


def null_columns(df: DataFrame, keep: Collection[str] = ()) -> list[str]:
    """Columns without a single value; none for an empty frame."""
    profile = null_profile(df).where((F.col("n_null") == F.col("n_rows")) & (F.col("n_rows") > 0))
    return [r["column"] for r in profile.collect() if r["column"] not in keep]


def drop_null_columns(df: DataFrame, keep: Collection[str] = ()) -> DataFrame:
    """Drop the columns that hold nothing but nulls, except those in ``keep``."""
    return df.drop(*null_columns(df, keep))


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return df.na.drop("any")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Drop exact copies; each map task already collapses its own."""
    return df.dropDuplicates()


def drop_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the one whose other columns, in order, are smallest.

    A minimum combines on the map side, so a key with very many copies is
    reduced before the shuffle, and the survivor does not depend on task order.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    return smallest.select(*keys, *[F.col("row")[c].alias(c) for c in rest]).select(df.columns)


def clean(df: DataFrame) -> DataFrame:
    """Without exact copies, empty columns and rows with nulls, as if removed in
    that order.

    Copies cannot make a column empty or a row null, so the cheap steps run
    first: one column scan finds the empty columns, and only complete rows
    enter the shuffle that removes copies.
    """
    return drop_duplicate_rows(drop_null_rows(drop_null_columns(df)))
