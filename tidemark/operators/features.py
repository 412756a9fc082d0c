"""Feature preparation: combining layers, increments, indicators, key lookup."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.writers import days_shared, without_days

# Every category becomes a column; more than this many have to be asked for, in
# case a key was taken for a category.
MAX_CATEGORIES = 1_000


def combine_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both frames; a column only one of them has is null in the other."""
    return first.unionByName(second, allowMissingColumns=True)


def distinct_days(df: DataFrame, day_col: str) -> DataFrame:
    """The days a table holds."""
    return df.select(day_col).distinct()


def new_days_only(df: DataFrame, existing: DataFrame | None, day_col: str) -> DataFrame:
    """Rows of days that ``existing`` does not hold; all rows if it is missing.

    Of ``existing`` only the days from the first to the last of ``df`` are read.
    """
    if existing is None:
        return df
    return without_days(df, days_shared(df, existing, day_col), day_col)


def clean_name(name: str) -> str:
    """A column name without blanks and ``<``."""
    return re.sub(r"[ <]", "", name)


def categories_of(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list:
    """Sorted values of a categorical column, without null."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    found = sorted(r[0] for r in values.limit(limit + 1).collect())
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values")
    return found


def one_hot(df: DataFrame, column: str, target: str | None = None,
            categories: Sequence | None = None, max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """Replace a categorical column by 0/1 columns and drop the target.

    Give ``categories`` to fix the columns; otherwise they are the values found.
    A null category has 0 in every indicator.
    """
    if categories is None:
        categories = categories_of(df, column, max_categories)
    rest = [c for c in df.columns if c not in (column, target)]
    names = [*map(clean_name, rest), *[clean_name(str(v)) for v in categories]]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns collide after renaming: {twice}")
    flags = [F.col(column).eqNullSafe(F.lit(v)).cast("int") for v in categories]
    kept = [F.col(f"`{c}`") for c in rest]
    return df.select(*[c.alias(n) for c, n in zip([*kept, *flags], names)])


def lookup_features(labels: DataFrame, features: DataFrame, keys: Sequence[str],
                    keep_keys: bool = False) -> DataFrame:
    """Labels with the features of their key, null where there are none.

    The feature table has one row per key, so only the labels can be skewed;
    they are the preserved side, which adaptive execution may split.
    """
    joined = labels.join(features, on=list(keys), how="left")
    return joined if keep_keys else joined.drop(*keys)


def unmatched(labels: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the number of labels without features."""
    return labels.join(features.select(*keys), on=list(keys), how="left_anti").agg(
        F.count(F.lit(1)).alias("n_unmatched"))
