"""Running sums over a total order too long for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import broadcast_within, durable


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str],
                 sums: Sequence[str]) -> DataFrame:
    """Add ``<c>_upto``, the inclusive running sum of each of ``sums`` in
    ``order`` within ``by``.

    A window over ``by`` would put a whole group into one task. Here the rows
    are cut into consecutive slices by range, each slice is summed by itself,
    and the totals of the slices before it are added. The slice number is a
    stored column of a written table, so that a task which is run again cannot
    see another slicing. ``order`` must be unique within ``by``: equal rows
    would land in one slice, however many there are.
    """
    sliced = durable(
        df.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id())
    )
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # A handful of rows per slice: a group occurs in consecutive slices only.
    totals = durable(
        sliced.groupBy("_slice", *by).agg(*[F.sum(c).alias(c) for c in sums])
    )
    offsets = totals.select(
        F.col("_slice").alias("_of_slice"), *[F.col(c).alias(f"_of_{c}") for c in by],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_before") for c in sums],
    )
    inside = Window.partitionBy("_slice", *by).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    summed = sliced.select("*", *[F.sum(c).over(inside).alias(f"_{c}_in") for c in sums])
    # A null group is a group: plain equality would lose its rows.
    same = F.col("_slice") == F.col("_of_slice")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = summed.join(broadcast_within(offsets), on=same)
    return joined.select(
        *df.columns,
        *[(F.col(f"_{c}_in") + F.col(f"_{c}_before")).alias(f"{c}_upto") for c in sums],
    )
