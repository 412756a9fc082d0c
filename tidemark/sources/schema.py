"""Stored schemas of file tables, which grow by added columns and wider types.

A schema is kept below its table as numbered versions (``_schema/v000001``), which readers of the
data skip. A version is never changed; the highest one counts. Files written
before a column was added give null in it, and numbers read with the wider type.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StructField,
    StructType,
)

FOLDER = "_schema"
FORMATS = ("parquet", "orc")
INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def wider(old: DataType, new: DataType) -> DataType | None:
    """The narrower-to-wider common type that keeps every value of both exactly; None if there is none."""
    if old == new or isinstance(new, NullType):
        return old
    if isinstance(old, NullType):
        return new
    for a, b in ((old, new), (new, old)):
        if isinstance(a, INTEGRAL) and isinstance(b, INTEGRAL):
            return max(a, b, key=lambda t: INTEGRAL.index(type(t)))
        if isinstance(a, FloatType) and isinstance(b, DoubleType):
            return b
        if isinstance(a, (ByteType, ShortType, IntegerType)) and isinstance(b, DoubleType):
            return b
        if isinstance(a, INTEGRAL) and isinstance(b, DecimalType):
            if b.precision - b.scale >= DIGITS[type(a)]:
                return b
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        scale = max(old.scale, new.scale)
        digits = max(old.precision - old.scale, new.precision - new.scale)
        if digits + scale <= 38:
            return DecimalType(digits + scale, scale)
    return None


def merged(old: StructType, new: StructType) -> StructType:
    """``old`` with the types widened and the columns added that ``new`` needs.

    Columns keep their order, added ones come last; all are nullable. What cannot be
    widened without loss is refused with the names of all such columns.
    """
    given = {f.name: f.dataType for f in new.fields}
    out, refused = [], []
    for f in old.fields:
        kind = wider(f.dataType, given.pop(f.name, f.dataType))
        if kind is None:
            refused.append(f"{f.name}: {f.dataType.simpleString()} and {new[f.name].dataType.simpleString()}")
        out.append(StructField(f.name, kind or f.dataType))
    if refused:
        raise ValueError(f"types that do not widen: {', '.join(refused)}")
    twice = {n.lower() for n in given} & {f.name.lower() for f in out}
    if twice:
        raise ValueError(f"columns that differ by case only: {sorted(twice)}")
    return StructType(out + [StructField(n, t) for n, t in given.items() if not isinstance(t, NullType)])


def _versions(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    # A version counts once it was written whole.
    marked = [s.getPath() for s in files.listStatus(folder)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(p.getName() for p in marked if files.exists(done(p, "_SUCCESS")))


def stored(spark: SparkSession, path: str) -> StructType | None:
    """The table's stored schema, if it has one."""
    versions = _versions(spark, path)
    if not versions:
        return None
    text = spark.read.text(f"{path}/{FOLDER}/{versions[-1]}", wholetext=True).first()[0]
    return StructType.fromJson(json.loads(text))


def store(spark: SparkSession, path: str, schema: StructType) -> None:
    """Add a version. Of two writers of the same version one fails, since it is there already."""
    versions = _versions(spark, path)
    number = int(versions[-1][1:]) + 1 if versions else 1
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(
        f"{path}/{FOLDER}/v{number:06d}")


def grow(spark: SparkSession, path: str, current: StructType, batch: StructType) -> StructType:
    """The schema that holds both the table's rows and the batch; stored if the table's must change.

    Store it before the rows: a write that fails then leaves no more than a column of nulls.
    """
    schema = merged(current, batch)
    if {(f.name, f.dataType) for f in schema.fields} != {(f.name, f.dataType) for f in current.fields}:
        store(spark, path, schema)
    return schema


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``; columns it lacks are null."""
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])
