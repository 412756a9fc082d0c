"""Declarative data-quality rules, checked together.

All rules that look at single rows share one aggregation over the table; a
uniqueness rule adds one group-by; schema rules read no data. The result has
one row per rule.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import percent, text_length
from tidemark.sources.writers import stamp

RESULT_COLUMNS = (
    "suite", "table", "rule", "column", "severity", "element_count",
    "unexpected_count", "unexpected_percent", "threshold", "success",
)

# Type names a column may have to count as numeric: fixed values, the second
# list being the one for feature tables, which hold floats but no decimals.
NUMERIC_TYPES = ("IntegerType", "LongType", "DecimalType", "DoubleType")
FEATURE_TYPES = ("IntegerType", "LongType", "FloatType", "DoubleType")


class GateError(Exception):
    """A gated suite has failed rules."""

    def __init__(self, failures: list[str]):
        super().__init__("failed checks: " + "; ".join(failures))
        self.failures = failures


@dataclass(frozen=True)
class NotNull:
    """Values present, in at least the fraction ``mostly`` of the rows."""

    column: str
    mostly: float = 1.0
    severity: str = "ERROR"
    rule = "not_null"

    def unexpected(self) -> Column:
        return F.count_if(F.col(self.column).isNull())

    @property
    def threshold(self) -> str:
        return f"mostly={float(self.mostly)}"

    def passes(self, rows: Column, unexpected: Column) -> Column:
        return (rows == 0) | ((rows - unexpected) / rows >= F.lit(float(self.mostly)))


@dataclass(frozen=True)
class ValueLength:
    """Length of the value as text within bounds; nulls pass."""

    column: str
    low: int
    high: int
    severity: str = "WARN"
    rule = "value_length"

    def unexpected(self) -> Column:
        return F.count_if(~text_length(F.col(self.column)).between(self.low, self.high))

    @property
    def threshold(self) -> str:
        return f"{self.low}..{self.high}"

    def passes(self, rows: Column, unexpected: Column) -> Column:
        return unexpected == 0


@dataclass(frozen=True)
class ValueRange:
    """Value itself within bounds; nulls pass."""

    column: str
    low: float
    high: float
    severity: str = "WARN"
    rule = "value_range"

    def unexpected(self) -> Column:
        return F.count_if(~F.col(self.column).between(self.low, self.high))

    @property
    def threshold(self) -> str:
        return f"{self.low}..{self.high}"

    def passes(self, rows: Column, unexpected: Column) -> Column:
        return unexpected == 0


@dataclass(frozen=True)
class RowCount:
    """Exactly ``expected`` rows; the unexpected count is the distance from it."""

    expected: int
    severity: str = "WARN"
    column = "*"
    rule = "row_count"

    def unexpected(self) -> Column:
        return F.abs(F.count(F.lit(1)) - F.lit(self.expected))

    @property
    def threshold(self) -> str:
        return str(self.expected)

    def passes(self, rows: Column, unexpected: Column) -> Column:
        return unexpected == 0


@dataclass(frozen=True)
class Unique:
    """Compound key unique: every row of a repeated key counts as unexpected.

    Rows whose key columns are all null are skipped.
    """

    columns: tuple[str, ...]
    severity: str = "WARN"
    rule = "unique"

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    threshold = "1 row per key"


@dataclass(frozen=True)
class ColumnCount:
    """Exactly ``expected`` columns."""

    expected: int
    severity: str = "WARN"
    column = "*"
    rule = "column_count"

    @property
    def threshold(self) -> str:
        return str(self.expected)

    def check(self, df: DataFrame) -> tuple[int, int]:
        return len(df.columns), abs(len(df.columns) - self.expected)


@dataclass(frozen=True)
class HasColumn:
    """The column exists."""

    column: str
    severity: str = "ERROR"
    rule = "has_column"
    threshold = "present"

    def check(self, df: DataFrame) -> tuple[int, int]:
        return 1, int(self.column not in df.columns)


@dataclass(frozen=True)
class TypeIn:
    """The column has one of the named types."""

    column: str
    types: tuple[str, ...] = field(default=NUMERIC_TYPES)
    severity: str = "ERROR"
    rule = "type_in"

    @property
    def threshold(self) -> str:
        return "|".join(self.types)

    def check(self, df: DataFrame) -> tuple[int, int]:
        known = {f.name: type(f.dataType).__name__ for f in df.schema.fields}
        return 1, int(known.get(self.column) not in self.types)


def run_suite(df: DataFrame, rules: Sequence, *, suite: str, table: str) -> DataFrame:
    """Check ``rules`` on ``df``; one result row per rule, nothing runs yet.

    A rule on a column that the table does not have fails, without counts; the others are checked.
    """
    absent = [r for r in rules if not hasattr(r, "check") and not _resolves(df, r)]
    row_rules = [r for r in rules if hasattr(r, "unexpected") and r not in absent]
    key_rules = [r for r in rules if isinstance(r, Unique) and r not in absent]
    schema_rules = [r for r in rules if hasattr(r, "check")]
    parts = []
    if row_rules:
        parts.append(_row_results(df, row_rules, suite, table))
    parts += [_key_result(df, rule, suite, table) for rule in key_rules]
    if schema_rules:
        parts.append(_schema_results(df, schema_rules, suite, table))
    if absent:
        none = F.lit(None).cast("long")
        failed = [_result(r, suite, table, none, none, F.lit(False)) for r in absent]
        parts.append(df.sparkSession.range(1).select(F.inline(F.array(*failed))))
    if not parts:
        raise ValueError("a suite needs at least one rule")
    return reduce(DataFrame.unionByName, parts)


def _resolves(df: DataFrame, rule) -> bool:
    """Has the table the columns that the rule is about?"""
    names = rule.columns if isinstance(rule, Unique) else () if rule.column == "*" else (rule.column,)
    try:
        return len(df.select(*names).columns) == len(names)
    except AnalysisException:
        return False


def _result(rule, suite: str, table: str, rows: Column, unexpected: Column,
            success: Column) -> Column:
    values = {
        "suite": F.lit(suite),
        "table": F.lit(table),
        "rule": F.lit(rule.rule),
        "column": F.lit(rule.column),
        "severity": F.lit(rule.severity),
        "element_count": rows.cast("long"),
        "unexpected_count": unexpected.cast("long"),
        "unexpected_percent": F.when(rows.isNotNull(), percent(unexpected, rows)),
        "threshold": F.lit(rule.threshold),
        "success": success,
    }
    return F.struct(*[values[c].alias(c) for c in RESULT_COLUMNS])


def _row_results(df: DataFrame, rules: Sequence, suite: str, table: str) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[rule.unexpected().alias(f"u{i}") for i, rule in enumerate(rules)],
    )
    rows = F.col("rows")
    results = [
        _result(rule, suite, table, rows, F.col(f"u{i}"), rule.passes(rows, F.col(f"u{i}")))
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*results)))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of rows, and of rows whose key is not theirs alone."""
    some_key = reduce(Column.__or__, [F.col(k).isNotNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    repeated = F.when(some_key & (F.col("copies") > 1), F.col("copies")).otherwise(0)
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(repeated), F.lit(0)).alias("repeated"),
    )


def _key_result(df: DataFrame, rule: Unique, suite: str, table: str) -> DataFrame:
    result = _result(rule, suite, table, F.col("rows"), F.col("repeated"),
                     F.col("repeated") == 0)
    return key_counts(df, rule.columns).select(F.inline(F.array(result)))


def _schema_results(df: DataFrame, rules: Sequence, suite: str, table: str) -> DataFrame:
    results = []
    for rule in rules:
        total, unexpected = rule.check(df)
        results.append(_result(rule, suite, table, F.lit(total), F.lit(unexpected),
                               F.lit(unexpected == 0)))
    return df.sparkSession.range(1).select(F.inline(F.array(*results)))


def require_passed(results: DataFrame) -> None:
    """Raise ``GateError`` naming every failed rule; one row per rule at most."""
    failed = results.where(~F.col("success")).collect()
    if failed:
        raise GateError([
            f"{r['table']}: {r['rule']} on {r['column']}: "
            + ("absent" if r["element_count"] is None else f"{r['unexpected_count']} of {r['element_count']}")
            for r in failed
        ])


def record_results(results: DataFrame, path: str, run_date: dt.date | str | None = None,
                   fmt: str = "parquet") -> None:
    """Append results, with the date of the run, to the table of check results."""
    stamped = stamp(results, run_date, "run_date")
    stamped.coalesce(1).write.format(fmt).mode("append").save(path)
