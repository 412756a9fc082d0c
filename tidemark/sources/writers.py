"""Writing layered tables: overwrite, append, daily increments, backfill, rebuild."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import broadcast_within, durable, scratch_path
from tidemark.sources import schema
from tidemark.sources.readers import read_if_exists, read_table

FILE_FORMATS = ("parquet", "orc", "json", "csv", "text")


def stamp(df: DataFrame, run_date: dt.date | str | None = None,
          column: str = "partition_date") -> DataFrame:
    """Add the ingest date, today unless ``run_date`` is given."""
    day = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return df.withColumn(column, day)


def write_table(
    df: DataFrame,
    path: str,
    *,
    table: str | None = None,
    partition_by: str | None = "partition_date",
    mode: str = "overwrite",
    fmt: str = "parquet",
    rebalance: bool = False,
) -> None:
    """Write an external, partitioned table; registered in the catalog if named.

    ``rebalance`` first groups rows by the partition column, which gives few
    large files; adaptive execution splits a day too large for one task. A
    frame with a constant partition value does not need it.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if it is missing."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def ingest_tables(
    tables: Mapping[str, DataFrame],
    root: str,
    *,
    run_date: dt.date | str | None = None,
    database: str | None = None,
    parallel: int = 4,
    fmt: str = "parquet",
) -> None:
    """Stamp and write every table below ``root``.

    Each write is a distributed job of its own; a few are submitted at a time
    so that small tables do not leave the cluster idle.
    """
    def write(item):
        name, df = item
        write_table(stamp(df, run_date), f"{root}/{name}", fmt=fmt,
                    table=f"{database}.{name}" if database else None)

    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(write, tables.items()))


def days_present(table: DataFrame | None, day_col: str, first=None,
                 last=None) -> DataFrame | None:
    """The days, of a range if given, that hold at least one row; None without a
    table. Other partitions than those of the range are not read."""
    if table is None:
        return None
    held = table.select(day_col)
    if first is not None:
        held = held.where(F.col(day_col).between(F.lit(first), F.lit(last)))
    return durable(held.distinct())


def days_shared(df: DataFrame, table: DataFrame, day_col: str) -> DataFrame:
    """The days of ``table`` from the first to the last of ``df``, and null; other partitions are not read."""
    first, last = df.agg(F.min(day_col), F.max(day_col)).first()
    near = F.col(day_col).isNull()
    if first is not None:
        near = near | F.col(day_col).between(F.lit(first), F.lit(last))
    return durable(table.where(near).select(day_col).distinct())


def holds_day(spark: SparkSession, path: str, day: dt.date | str, day_col: str = "Date",
              fmt: str = "parquet") -> bool:
    """Whether the table partitioned by day has a row of ``day``.

    Opens the directory of that day only, where the format has directories;
    listing a long-lived table takes longer than most days' work.
    """
    if fmt in FILE_FORMATS:
        rows = read_if_exists(spark, f"{path}/{day_col}={day}", fmt)
    else:
        rows = read_if_exists(spark, path, fmt)
        rows = rows if rows is None else rows.where(F.col(day_col) == F.lit(day))
    return rows is not None and not rows.isEmpty()


def without_days(df: DataFrame, days: DataFrame | None, day_col: str) -> DataFrame:
    """Rows of ``df`` whose day is not among ``days``; null matches null."""
    if days is None:
        return df
    held = broadcast_within(days.select(F.col(day_col).alias("_held_day")))
    return df.join(held, df[day_col].eqNullSafe(held["_held_day"]), "left_anti")


def append_new_days(
    df: DataFrame,
    path: str,
    *,
    day_col: str = "Date",
    table: str | None = None,
    fmt: str = "parquet",
    rebalance: bool = False,
    day: dt.date | str | None = None,
    widen: bool = False,
) -> None:
    """Append only the days the target does not hold, so a re-run adds nothing.

    Give ``day`` if ``df`` is about a single one: if the target has it, nothing
    is computed at all, and otherwise only that partition has been looked at.

    Rows take the target's columns and types: missing columns become null, and
    those the target lacks are refused by name. With ``widen`` the target takes the new columns and wider
    types instead: its stored schema grows, earlier rows have null there, and no file is rewritten.
    Check and append are two steps; run one writer per table.
    """
    spark = df.sparkSession
    if day is not None:
        if holds_day(spark, path, day, day_col, fmt):
            return
        df = df.where(F.col(day_col) == F.lit(day))
    target = read_if_exists(spark, path, fmt)
    if target is not None:
        extra = set(df.columns) - set(target.columns)
        if extra and not widen:
            raise ValueError(f"columns not in the target table: {sorted(extra)}")
        fresh = df
        if day is None:
            held = days_shared(df, target, day_col)
            fresh = without_days(df, held, day_col)
        known = target.schema
        if widen:
            fresh = durable(fresh)
            if fresh.isEmpty():
                return
            known = schema.grow(spark, path, target.schema, df.schema)
        df = schema.conform(fresh, known)
    write_table(df, path, table=table, partition_by=day_col, mode="append", fmt=fmt,
                rebalance=rebalance)


def calendar(spark: SparkSession, start: dt.date | str, end: dt.date | str,
             day_col: str = "Date") -> DataFrame:
    """One row per day of the inclusive range."""
    start, end = _as_date(start), _as_date(end)
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    span = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(span).alias(day_col))


def missing_days(calendar_days: DataFrame, present: DataFrame | None,
                 day_col: str = "Date") -> DataFrame:
    """Calendar days without data."""
    return without_days(calendar_days, present, day_col)


def backfill_days(
    spark: SparkSession,
    start: dt.date | str,
    end: dt.date | str,
    path: str,
    make_rows: Callable[[Sequence[dt.date]], DataFrame],
    *,
    day_col: str = "Date",
    table: str | None = None,
    fmt: str = "parquet",
) -> list[dt.date]:
    """Fill every missing day of the range in one partitioned write.

    ``make_rows`` gets the missing days, a list bounded by the calendar, and
    returns their rows as one frame.
    """
    present = days_present(
        read_if_exists(spark, path, fmt), day_col, _as_date(start), _as_date(end))
    gaps = missing_days(calendar(spark, start, end, day_col), present, day_col)
    days = sorted(row[0] for row in gaps.collect())
    if days:
        write_table(make_rows(days), path, table=table, partition_by=day_col,
                    mode="append", fmt=fmt)
    return days


def rebuild_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: str | None = "partition_date",
    table: str | None = None,
    fmt: str = "parquet",
    reads_target: bool = False,
    rebalance: bool = False,
) -> None:
    """Overwrite every partition of a layer.

    With ``reads_target`` the new content is first written aside, because
    overwriting would delete the files it is computed from; the copy also is
    what remains to recover from should the overwrite be interrupted.
    """
    if reads_target:
        spark = df.sparkSession
        staged = scratch_path(spark, "rebuild")
        write_table(df, staged, partition_by=None, fmt=fmt)
        df = read_table(spark, staged, fmt)
    write_table(df, path, table=table, partition_by=partition_by, fmt=fmt, rebalance=rebalance)


def _as_date(day: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day
