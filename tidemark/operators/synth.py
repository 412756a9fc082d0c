"""Profiles of a table, and seeded synthetic rows that follow them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, NumericType

from tidemark.durable import durable, scratch_path
from tidemark.functions.columns import unit_hash
from tidemark.operators.running import running_sums

ROWS_PER_DAY = 10_000


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def numeric_profile(df: DataFrame) -> DataFrame:
    """Type, minimum and maximum of every numeric column, in one pass."""
    names = numeric_columns(df)
    ends = df.agg(
        *[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(names)],
        *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(names)],
    )
    types = dict(df.dtypes)
    lines = [
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(names)
    ]
    return ends.select(F.inline(F.array(*lines)))


def value_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values, null included, of every other column, as text."""
    names = other_columns(df) if columns is None else columns
    lines = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in names
    ]
    return df.select(F.inline(F.array(*lines))).distinct()


@dataclass(frozen=True)
class Profile:
    """What synthetic rows are drawn from; columns in the order of the table.

    ``ranges`` has the ends of numeric columns; ``dictionary`` is a table
    ``(position, value, column)`` of the sorted values of all others, written in one
    directory per column, and ``sizes`` how many of them a column has.
    """

    types: dict[str, DataType]
    ranges: dict[str, tuple]
    sizes: dict[str, int]
    dictionary: DataFrame | None


def profile_table(df: DataFrame, exclude: Sequence[str] = ()) -> Profile:
    """Profile of all columns but ``exclude`` (an id, the day).

    One pass for the ranges, one for the values. Columns without any value
    are generated as null.
    """
    df = df.drop(*exclude)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric, other = numeric_columns(df), other_columns(df)
    ranges = {}
    if numeric:
        row = df.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(numeric)],
                     *[F.max(c).alias(f"hi{i}") for i, c in enumerate(numeric)]).first()
        ranges = {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(numeric)}
    if not other:
        return Profile(types, ranges, {}, None)
    found = durable(value_profile(df, other))
    sizes = {r["column"]: r["count"] for r in found.groupBy("column").count().collect()}
    ranked = running_sums(found.withColumn("n", F.lit(1).cast("long")), ["column"], ["value"], ["n"])
    path = scratch_path(df.sparkSession, "dictionary")
    ranked.select(F.col("n_upto").alias("position"), "value", "column").write.partitionBy("column").parquet(path)
    dictionary = df.sparkSession.read.schema("position long, value string, column string").parquet(path)
    return Profile(types, ranges, {c: sizes.get(c, 0) for c in other}, dictionary)


def _in_range(u: Column, low, high, dtype: DataType) -> Column:
    if low is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, IntegralType):
        drawn = F.floor(F.lit(float(low)) + u * F.lit(float(high - low + 1)))
        return F.least(drawn, F.lit(int(high))).cast(dtype)
    return (F.lit(float(low)) + u * F.lit(float(high) - float(low))).cast(dtype)


def _position(u: Column, size: int) -> Column:
    return F.least(F.floor(u * F.lit(float(size))) + 1, F.lit(size))


def synth_rows(
    spark: SparkSession,
    profile: Profile,
    days: Sequence[dt.date],
    *,
    rows_per_day: int = ROWS_PER_DAY,
    seed: int = 0,
    id_col: str = "house_id",
    day_col: str = "Date",
) -> DataFrame:
    """``rows_per_day`` rows for each of ``days``, ids 1..n within a day.

    Every cell is a hash of seed, column, day and id: the same rows come out
    whatever the number of tasks. Days are laid out one after the other in a
    single range, so a task writes to few of them. Numeric cells fall between
    the ends of the profile, others are one of its values.
    """
    if not days:
        raise ValueError("no days to generate")
    index = F.floor(F.col("id") / F.lit(rows_per_day)).cast("int") + 1
    rows = spark.range(len(days) * rows_per_day).select(
        (F.col("id") % rows_per_day + 1).alias(id_col),
        F.element_at(F.array(*[F.lit(d) for d in days]), index).alias(day_col),
    )

    def draw(column: str) -> Column:
        return unit_hash(F.lit(seed), F.lit(column), F.col(day_col), F.col(id_col))

    cells = {}
    for c, (low, high) in profile.ranges.items():
        cells[c] = _in_range(draw(c), low, high, profile.types[c])
    # Without observed values a column stays null.
    cells |= {c: F.lit(None).cast(profile.types[c]) for c, size in profile.sizes.items() if not size}
    rows = rows.withColumns(cells) if cells else rows
    for c, size in profile.sizes.items():
        if size:
            # Only the directory of the column is read: its size decides how it is joined.
            choices = profile.dictionary.where(F.col("column") == c).select(
                F.col("position").alias("_position"), F.col("value").cast(profile.types[c]).alias(c))
            rows = rows.withColumn("_position", _position(draw(c), size)).join(choices, "_position").drop("_position")
    return rows.select(id_col, *profile.types, day_col)
