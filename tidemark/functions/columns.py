"""Scalar expressions; all of them stay inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1] from the first 32 bits of the md5 of ``parts``.

    Depends on the values only, never on partitioning or task order.
    """
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def hash_percent(*parts: Column) -> Column:
    """An integer in 0..99 from the md5 of ``parts``; drives stable splits."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100).cast("int")


def sign_flag(value: Column) -> Column:
    """1 for a positive number, otherwise 0; zero counts as not positive."""
    return F.when(value > 0, 1).otherwise(0)


def sign_flags(values: Column) -> Column:
    """``sign_flag`` of each element of an array column."""
    return F.transform(values, sign_flag)


def text_length(value: Column) -> Column:
    """Length of the value written as text; numbers are written out first."""
    return F.length(value.cast("string"))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, two digits; 0 when there is no whole."""
    share = F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)
    return F.coalesce(share, F.lit(0.0))


def ks_p_value(statistic: Column, n_ref: Column, n_test: Column) -> Column:
    """Two-sided tail of the Kolmogorov distribution.

    The alternating series does not converge near zero, where the tail is 1 to
    more than ten digits: below 0.2 the answer is 1.
    """
    n_ref, n_test = n_ref.cast("double"), n_test.cast("double")
    scaled = F.sqrt(n_ref * n_test / (n_ref + n_test)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        * F.exp(F.lit(-2.0) * k * k * scaled * scaled),
    )
    tail = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series))
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(tail)


def _erfc_of_root(x: Column) -> Column:
    """erfc(sqrt(x)); the power series of erf, whose terms are all positive."""
    first = F.lit(2.0 / math.sqrt(math.pi)) * F.sqrt(x) * F.exp(-x)
    erf = F.aggregate(
        F.sequence(F.lit(1), F.lit(200)),
        F.struct(first.alias("term"), first.alias("total")),
        lambda acc, k: F.struct(
            (acc["term"] * x / (k + 0.5)).alias("term"),
            (acc["total"] + acc["term"] * x / (k + 0.5)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    # Below 1e-18 from here on, where a difference from 1 is only noise.
    return F.when(x > 40, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 1.0 - erf))


def chi_square_p_value(statistic: Column, df: Column) -> Column:
    """P(X >= statistic) of the chi-square distribution with ``df`` degrees.

    Starts from one or two degrees and adds x^a e^-x / gamma(a + 1), kept as a
    logarithm, for every two more.
    """
    x = statistic / 2.0
    odd = df % 2 == 1
    log_first = F.when(odd, F.lit(math.log(2.0 / math.sqrt(math.pi))) + F.log(x) / 2 - x).otherwise(
        F.log(x) - x)
    steps = F.when(df > 2, F.sequence(F.lit(1), F.floor((df - 1) / 2).cast("int"))).otherwise(
        F.array().cast("array<int>"))
    added = F.aggregate(
        steps,
        F.struct(log_first.alias("log_term"), F.lit(0.0).alias("total")),
        lambda acc, k: F.struct(
            (acc["log_term"] + F.log(x / (k + F.when(odd, 0.5).otherwise(1.0)))).alias("log_term"),
            (acc["total"] + F.exp(acc["log_term"])).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    start = F.when(odd, _erfc_of_root(x)).otherwise(F.exp(-x))
    return F.when((df <= 0) | (statistic <= 0), F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), start + added))
