"""Drift between a reference and a test population, feature by feature."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.functions.columns import chi_square_p_value, ks_p_value
from tidemark.operators.running import running_sums

BUCKETS = 512


def reference_rows(features: DataFrame, training_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Feature rows that were trained on, each once."""
    wanted = training_keys.select(*keys).distinct()
    return features.join(wanted, on=list(keys), how="left_semi")


def reference_rows_left(features: DataFrame, training_keys: DataFrame,
                        keys: Sequence[str]) -> DataFrame:
    """Every feature row, repeated once per training row of its key.

    This is the left join of features with training keys, which filters
    nothing. It is taken apart so that a key with very many training rows can
    be split: matched rows by an inner join, where adaptive execution may split
    either side, and the rest by an anti join. ``features`` has unique keys.
    """
    wanted = training_keys.select(*keys)
    matched = features.join(wanted, on=list(keys)).select(features.columns)
    rest = features.join(wanted.distinct(), on=list(keys), how="left_anti")
    return matched.unionByName(rest.select(features.columns))


def _both(reference: DataFrame, test: DataFrame, columns: Sequence[Column]) -> DataFrame:
    return reference.select(F.lit(1).alias("in_ref"), *columns).unionByName(
        test.select(F.lit(0).alias("in_ref"), *columns))


def _gap(ref: Column, test: Column) -> Column:
    """Difference of the two distribution functions; null if a sample is empty."""
    return F.try_divide(ref, F.col("n_ref")) - F.try_divide(test, F.col("n_test"))



def _sizes() -> list[Column]:
    return [F.sum("in_ref").alias("ref"), F.sum(1 - F.col("in_ref")).alias("test")]


def _edges(wide: DataFrame, names: Sequence[str], buckets: int) -> list[list[float]]:
    """Bucket bounds per feature: quantiles of a mergeable sketch, all features in one pass.

    Any bounds give the same test result. Good ones only make the buckets even.
    """
    ranks = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    sketches = wide.agg(*[
        F.kll_sketch_agg_double(F.when(~F.isnan(c), F.col(c))).alias(c) for c in names])
    found = sketches.select(*[
        F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(F.col(c), ranks)).alias(c)
        for c in names]).first()
    inner = [sorted({q for q in qs or [] if math.isfinite(q)}) or [0.0] for qs in found]
    return [[-math.inf, *edges, math.inf] for edges in inner]


def _melt(wide: DataFrame, cells: dict[str, dict[str, Column]]) -> DataFrame:
    """One row per value that is a number, with its feature and ``cells``."""
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value"),
                 *[column.alias(name) for name, column in more.items()])
        for c, more in cells.items()
    ]
    return wide.select("in_ref", F.inline(F.array(*rows))).where(
        F.col("value").isNotNull() & ~F.isnan("value"))


def _bucketed(wide: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """The values of the features in ``edges``, with their buckets."""
    names = list(edges)
    outputs = {c: f"_b{i}" for i, c in enumerate(names)}
    bucketed = Bucketizer(
        splitsArray=list(edges.values()), inputCols=names, outputCols=list(outputs.values()),
        handleInvalid="keep",
    ).transform(wide.select("in_ref", *names))
    return _melt(bucketed, {c: {"bucket": F.col(o).cast("int")} for c, o in outputs.items()})


def ks_drift(reference: DataFrame, test: DataFrame, features: Sequence[str],
             buckets: int = BUCKETS) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per numeric feature.

    The statistic is exact, though only a sliver of the values is ever sorted,
    see ``_gaps``. Nulls and NaN are left out.
    """
    names = list(features)
    wide = _both(reference, test, [F.col(c).cast("double").alias(c) for c in names])
    tested = _gaps(wide, names, buckets).groupBy("feature").agg(
        F.max("n_ref").alias("n_ref"), F.max("n_test").alias("n_test"),
        F.max("gap").alias("gap"))
    # One empty sample leaves nothing to compare: no gap, no drift.
    statistic = F.coalesce("gap", F.lit(0.0))
    return tested.select(
        "feature", "n_ref", "n_test", statistic.alias("statistic"),
        ks_p_value(statistic, F.col("n_ref"), F.col("n_test")).alias("p_value"),
    )


def _gaps(wide: DataFrame, names: Sequence[str], buckets: int) -> DataFrame:
    """Gaps at all bucket ends, and at every value of the buckets that matter.

    Both samples are counted in buckets; that gives the gap of the distribution
    functions at every bucket end, and a bound on it inside every bucket. Only
    buckets that could hold a larger gap than the best one seen are looked at
    value by value.
    """
    edges = dict(zip(names, _edges(wide, names, buckets)))
    # At most features x buckets rows.
    coarse = durable(_bucketed(wide, edges).groupBy("feature", "bucket").agg(
        *_sizes(), F.min("value").alias("low"), F.max("value").alias("high")))
    whole = Window.partitionBy("feature")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = coarse.select(
        "feature", "bucket", "ref", "test", "low", "high",
        F.sum("ref").over(whole).alias("n_ref"),
        F.sum("test").over(whole).alias("n_test"),
        F.sum("ref").over(upto).alias("ref_upto"),
        F.sum("test").over(upto).alias("test_upto"),
    )
    ends = ends.withColumn("gap", F.abs(_gap(F.col("ref_upto"), F.col("test_upto")))).withColumn(
        "best", F.max("gap").over(whole))
    # Inside a bucket the reference alone, or the test alone, may rise first.
    ref_before, test_before = F.col("ref_upto") - F.col("ref"), F.col("test_upto") - F.col("test")
    bound = F.greatest(F.abs(_gap(F.col("ref_upto"), test_before)),
                       F.abs(_gap(ref_before, F.col("test_upto"))))
    # A bucket with a single value has no inside; its end is already exact.
    starts = ends.where((bound > F.col("best")) & (F.col("low") < F.col("high"))).select(
        "feature", "bucket", "n_ref", "n_test",
        ref_before.alias("ref_before"), test_before.alias("test_before"),
    )
    found = ends.select("feature", "n_ref", "n_test", "gap")
    open_ = [r["feature"] for r in starts.select("feature").distinct().collect()]
    if not open_:
        return found
    # Columns of features that are settled are not read again.
    values = _bucketed(wide, {c: edges[c] for c in names if c in open_})
    return found.unionByName(_gaps_inside(values, starts))


def _gaps_inside(values: DataFrame, starts: DataFrame) -> DataFrame:
    """Gap at every value of the buckets in ``starts``, at most features x buckets rows.

    A bucket may hold any number of values, so the order is cut into slices.
    """
    keys = ["feature", "bucket"]
    wanted = values.join(F.broadcast(starts.select(*keys)), on=keys)
    counted = running_sums(wanted.groupBy(*keys, "value").agg(*_sizes()), keys, ["value"], ["ref", "test"])
    gap = F.abs(_gap(F.col("ref_before") + F.col("ref_upto"),
                     F.col("test_before") + F.col("test_upto")))
    return counted.join(F.broadcast(starts), on=keys).select(
        "feature", "n_ref", "n_test", gap.alias("gap"))


def chi_square_drift(reference: DataFrame, test: DataFrame, features: Sequence[str],
                     correction: bool = True) -> DataFrame:
    """Chi-square test of the value counts per categorical feature.

    With ``correction``, a 2 x 2 table gets the continuity correction: each
    count moves by up to one half towards its expectation. Nulls are left out.
    """
    wide = _both(reference, test, [F.col(c).cast("string").alias(c) for c in features])
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in features
    ]
    long = wide.select("in_ref", F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(*_sizes())
    # One row per feature.
    totals = counts.groupBy("feature").agg(
        F.sum("ref").cast("double").alias("n_ref"),
        F.sum("test").cast("double").alias("n_test"),
        F.count(F.lit(1)).alias("k"),
    )
    cell = counts.join(F.broadcast(totals), on="feature")
    terms = []
    for name in ("ref", "test"):
        observed = F.col(name).cast("double")
        expected = F.col(f"n_{name}") * (F.col("ref") + F.col("test")).cast("double") / (
            F.col("n_ref") + F.col("n_test"))
        distance = F.abs(observed - expected)
        if correction:
            distance = F.when(
                F.col("k") == 2, F.greatest(distance - 0.5, F.lit(0.0))).otherwise(distance)
        # A population without rows expects nothing and adds nothing.
        terms.append(F.when(expected > 0, distance * distance / expected).otherwise(0.0))
    tested = cell.groupBy("feature").agg(
        F.first("n_ref").cast("long").alias("n_ref"),
        F.first("n_test").cast("long").alias("n_test"),
        F.sum(reduce(Column.__add__, terms)).alias("statistic"),
        F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).cast("int").alias("df"),
    )
    return tested.withColumn("p_value", chi_square_p_value(F.col("statistic"), F.col("df")))


def drift_verdict(tests: DataFrame, p_val: float = 0.5, bonferroni: bool = True) -> DataFrame:
    """One row: does any feature drift at ``p_val``, shared among the features?"""
    scored = tests.agg(F.count(F.lit(1)).alias("n_features"), F.min("p_value").alias("min_p"))
    limit = F.lit(float(p_val))
    if bonferroni:
        limit = limit / F.nullif(F.col("n_features"), F.lit(0))
    return scored.select(
        "n_features", "min_p", limit.alias("threshold"),
        F.coalesce(F.col("min_p") < limit, F.lit(False)).alias("is_drift"),
    )
