"""Reading whole tables, single partitions, CSV files, databases and inline rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources import schema


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A whole lake table by path, with its stored schema if it has one."""
    reader = spark.read.format(fmt).options(**options)
    known = schema.stored(spark, path) if fmt in schema.FORMATS else None
    return (reader if known is None else reader.schema(known)).load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A CSV file with a header line.

    Without ``schema`` the types are inferred, which reads the file twice.
    """
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_partition(
    spark: SparkSession, path: str, value, column: str = "Date", fmt: str = "parquet"
) -> DataFrame:
    """One partition of a table; the bare column comparison prunes directories."""
    return read_table(spark, path, fmt).where(F.col(column) == F.lit(value))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    schema: str = "dbo",
    split_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    predicates: Sequence[str] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One database table over several connections.

    Give ``split_column`` with its ``bounds`` and a number of ``partitions`` for
    evenly spread keys, or one SQL predicate per partition for skewed ones.
    Credentials come from ``options``; none are kept here.
    """
    name = f"{schema}.{table}" if schema else table
    try:
        if predicates:
            return spark.read.jdbc(url, name, predicates=list(predicates), properties=options or {})
        reader = spark.read.format("jdbc").options(**jdbc_options(
            url, name, split_column, bounds, partitions, options))
        return reader.load()
    except Exception as error:
        raise RuntimeError(f"cannot read table {name}") from error


def jdbc_options(url, name, split_column, bounds, partitions, options) -> dict[str, str]:
    """Options of the JDBC reader for a range-split read."""
    result = {"url": url, "dbtable": name, "fetchsize": "10000", **(options or {})}
    if partitions > 1:
        if split_column is None or bounds is None:
            raise ValueError("a split read needs split_column and bounds")
        result |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return result


def jdbc_bounds_query(table: str, column: str) -> str:
    """The subquery with the ends of a split column, to be read as a table."""
    return f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) bounds"


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str, *,
                schema: str = "dbo", options: dict[str, str] | None = None) -> tuple:
    """Ends of ``column``, computed by the database, for a split read."""
    name = f"{schema}.{table}" if schema else table
    row = read_jdbc(spark, url, jdbc_bounds_query(name, column), schema="",
                    options=options).first()
    return row[0], row[1]


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A frame from a few constant rows."""
    return spark.createDataFrame(list(rows), schema)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` a distributed top-n."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet",
                   **options) -> DataFrame | None:
    """The table at ``path``, or None if nothing is there; other failures propagate.

    Opening a table lists its files, so callers keep the frame they get.
    """
    try:
        return read_table(spark, path, fmt, **options)
    except AnalysisException as error:
        # The two "nothing there" conditions; anything else is a real failure.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def path_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether ``path`` holds a readable table."""
    return read_if_exists(spark, path, fmt) is not None


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the catalog knows ``name``."""
    return spark.catalog.tableExists(name)
