"""Keyed tables: creation with a checked primary key, and upsert without MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import durable, scratch_path
from tidemark.operators.quality import NotNull, Unique, require_passed, run_suite
from tidemark.sources import schema
from tidemark.sources.readers import read_if_exists, read_table
from tidemark.sources.writers import rebuild_table, write_table


def require_key(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raise unless ``keys`` identify every row: no nulls, no duplicates."""
    rules = [NotNull(k) for k in keys] + [Unique(tuple(keys), severity="ERROR")]
    require_passed(run_suite(df, rules, suite="primary key", table=name))


def create_keyed_table(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    table: str | None = None,
    partition_by: str | None = None,
    description: str = "",
    fmt: str = "parquet",
) -> None:
    """Write a table whose primary key has been checked; the key is recorded
    as a table property when the table is named."""
    require_key(df, keys, table or path)
    write_table(df, path, table=table, partition_by=partition_by, fmt=fmt)
    if table:
        df.sparkSession.sql(
            f"ALTER TABLE {table} SET TBLPROPERTIES "
            f"('primary_key' = '{','.join(keys)}', 'comment' = '{description}')"
        )


def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` replacing or joining its own.

    Source keys must be unique and, as in any primary key, not null. No column of either is dropped: where only
    one of them has a column, the rows of the other are null in it; types widen where no value changes.
    """
    both = schema.merged(target.schema, source.schema)
    kept = target.join(source.select(*keys), on=list(keys), how="left_anti")
    return schema.conform(kept, both).unionAll(schema.conform(source, both))


def only_partitions(table: DataFrame, column: str, values: Sequence) -> DataFrame:
    """``table`` within the given partitions; literals, so that other directories are not even listed."""
    named = [v for v in values if v is not None]
    held = F.col(column).isin(named) if named else F.lit(False)
    return table.where(held | F.col(column).isNull() if len(named) < len(values) else held)


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    *,
    partition_by: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Upsert ``source`` into the table at ``path``.

    When the partition column is part of the key, only the partitions that
    ``source`` touches are read and rewritten. ``source`` is computed once. Columns it adds, and wider types, become
    part of the table's stored schema.
    """
    source = durable(source)
    require_key(source, keys, path)
    target = read_if_exists(spark, path, fmt)
    if target is None:
        write_table(source, path, partition_by=partition_by, fmt=fmt)
        return
    if partition_by not in keys:
        rebuild_table(upsert_by_key(target, source, keys), path,
                      partition_by=partition_by, fmt=fmt, reads_target=True)
        return
    touched = [r[0] for r in source.select(partition_by).distinct().collect()]  # the directories to be written
    affected = only_partitions(target, partition_by, touched)
    staged = scratch_path(spark, "upsert")
    schema.grow(spark, path, target.schema, source.schema)
    write_table(upsert_by_key(affected, source, keys), staged, partition_by=None, fmt=fmt)
    (
        read_table(spark, staged, fmt)
        .hint("rebalance", F.col(partition_by))
        .write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by).save(path)
    )
