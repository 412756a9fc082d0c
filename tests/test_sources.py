import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.quality import GateError
from tidemark.sources import keyed, readers, writers

FIRST, LAST = dt.date(2022, 12, 7), dt.date(2022, 12, 14)


def days(spark, first, last, value=0):
    return writers.calendar(spark, first, last).withColumn("v", F.lit(value))


def held(spark, path):
    rows = spark.read.parquet(path).select("Date", "v").collect()
    return sorted((r["Date"], r["v"]) for r in rows)


def test_append_twice_is_append_once(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_new_days(days(spark, FIRST, FIRST), path)
    once = days(spark, FIRST, LAST, 1)
    writers.append_new_days(once, path)
    after = held(spark, path)
    assert after == [(FIRST, 0)] + [(FIRST + dt.timedelta(i), 1) for i in range(1, 8)]
    writers.append_new_days(once, path)
    assert held(spark, path) == after


def test_null_day_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(None, 1), (FIRST, 2)], "Date date, v int")
    for _ in range(2):
        writers.append_new_days(df, path)
    assert spark.read.parquet(path).count() == 2


def test_append_conforms_to_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_new_days(days(spark, FIRST, FIRST).withColumn("w", F.lit("x")), path)
    writers.append_new_days(days(spark, LAST, LAST), path)
    rows = spark.read.parquet(path).where(F.col("Date") == LAST).collect()
    assert [r["w"] for r in rows] == [None]
    with pytest.raises(ValueError, match="extra"):
        writers.append_new_days(days(spark, FIRST, LAST).withColumn("extra", F.lit(1)), path)


def test_backfill_fills_gaps_only_and_writes_once(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_new_days(days(spark, dt.date(2022, 12, 9), dt.date(2022, 12, 10)), path)
    asked = []

    def make_rows(missing):
        asked.append(missing)
        return spark.createDataFrame([(d, 1) for d in missing], "Date date, v int")

    filled = writers.backfill_days(spark, FIRST, LAST, path, make_rows)
    assert filled == [FIRST, dt.date(2022, 12, 8)] + [
        dt.date(2022, 12, 11) + dt.timedelta(i) for i in range(4)]
    assert asked == [filled]
    assert writers.backfill_days(spark, FIRST, LAST, path, make_rows) == []
    assert len(held(spark, path)) == 8


def test_backwards_range_is_refused(spark):
    with pytest.raises(ValueError):
        writers.calendar(spark, LAST, FIRST)


def test_one_partition_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_new_days(days(spark, FIRST, LAST), path)
    one = readers.read_partition(spark, path, "2022-12-09")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Date" in plan
    assert [r["Date"] for r in one.collect()] == [dt.date(2022, 12, 9)]


def test_rebuild_from_itself_keeps_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_new_days(days(spark, FIRST, LAST), path)
    doubled = readers.read_table(spark, path).withColumn("v", F.col("v") + 2)
    writers.rebuild_table(doubled, path, partition_by="Date", reads_target=True)
    assert held(spark, path) == [(FIRST + dt.timedelta(i), 2) for i in range(8)]


def test_named_external_table(spark, tmp_path):
    writers.create_database(spark, "layer", str(tmp_path / "db"))
    writers.create_database(spark, "layer", str(tmp_path / "db"))
    df = writers.stamp(spark.range(3).toDF("k"), "2024-02-01")
    assert not readers.table_exists(spark, "layer.t")
    writers.write_table(df, str(tmp_path / "t"), table="layer.t")
    writers.write_table(df, str(tmp_path / "t"), table="layer.t", mode="append")
    assert readers.table_exists(spark, "layer.t")
    assert spark.table("layer.t").count() == 6
    keyed.create_keyed_table(df, str(tmp_path / "f"), ["k"], table="layer.f")
    found = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES layer.f").collect()}
    assert found["primary_key"] == "k"


def test_stamp_defaults_to_today(spark):
    row = writers.stamp(spark.range(1)).select("partition_date", F.current_date()).first()
    assert row[0] == row[1]


def test_ingest_writes_every_table(spark, tmp_path):
    tables = {f"t{i}": spark.range(i) for i in range(1, 6)}
    writers.ingest_tables(tables, str(tmp_path), run_date="2024-02-01")
    for i in range(1, 6):
        rows = readers.read_table(spark, str(tmp_path / f"t{i}"))
        assert rows.count() == i
        assert rows.first()["partition_date"] == dt.date(2024, 2, 1)


def test_existence_probe(spark, tmp_path):
    assert not readers.path_exists(spark, str(tmp_path / "none"))
    (tmp_path / "bare").mkdir()
    assert not readers.path_exists(spark, str(tmp_path / "bare"))
    spark.range(1).write.parquet(str(tmp_path / "some"))
    assert readers.path_exists(spark, str(tmp_path / "some"))
    with pytest.raises(Exception):
        readers.path_exists(spark, str(tmp_path / "some"), fmt="no_such_format")


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    with open(path, "w") as out:
        out.write("house_id,price,Date\n1,2.5,2022-12-07\n")
    inferred = readers.read_csv(spark, path)
    assert [t for _, t in inferred.dtypes] == ["int", "double", "date"]
    given = readers.read_csv(spark, path, "house_id long, price double, Date date")
    assert given.first() == (1, 2.5, FIRST)


def test_inline_rows_and_preview(spark):
    people = readers.inline_rows(
        spark, [("Alice", 25), ("Bob", 30), ("Charlie", 35), ("Dave", 40)], "name string, age long")
    assert people.count() == 4
    assert [r["name"] for r in readers.preview(people, 2, ["name"]).collect()] == ["Alice", "Bob"]


def test_jdbc_options_split_the_read():
    options = readers.jdbc_options("jdbc:x", "dbo.t", "k", (0, 100), 8, {"user": "u"})
    assert options["dbtable"] == "dbo.t" and options["user"] == "u"
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "k", "0", "100", "8"]
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "dbo.t", None, None, 8, None)


def test_jdbc_bounds_are_left_to_the_database():
    assert readers.jdbc_bounds_query("dbo.t", "k") == (
        "(SELECT MIN(k) AS low, MAX(k) AS high FROM dbo.t) bounds")


def test_jdbc_failure_names_the_table(spark):
    with pytest.raises(RuntimeError, match="dbo.orders"):
        readers.read_jdbc(spark, "jdbc:nowhere:x", "orders")


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, FIRST, 1), (2, FIRST, 1), (3, LAST, 1)], "k int, Date date, v int")


def test_upsert_twice_is_upsert_once(spark, target, tmp_path):
    source = spark.createDataFrame([(3, LAST, 9), (4, LAST, 9)], "k int, Date date, v int")
    wanted = [(1, FIRST, 1), (2, FIRST, 1), (3, LAST, 9), (4, LAST, 9)]
    for keys, partition in ((["k"], None), (["k"], "Date"), (["k", "Date"], "Date")):
        path = str(tmp_path / f"t{len(keys)}{partition}")
        keyed.upsert_table(spark, path, target, keys, partition_by=partition)
        for _ in range(2):
            keyed.upsert_table(spark, path, source, keys, partition_by=partition)
            rows = spark.read.parquet(path).select("k", "Date", "v").collect()
            assert sorted(map(tuple, rows)) == wanted


def test_upsert_leaves_untouched_partitions_alone(spark, target, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert_table(spark, path, target, ["k", "Date"], partition_by="Date")
    before = {p.name for p in (tmp_path / "t" / f"Date={FIRST}").iterdir()}
    source = spark.createDataFrame([(3, LAST, 9)], "k int, Date date, v int")
    keyed.upsert_table(spark, path, source, ["k", "Date"], partition_by="Date")
    assert {p.name for p in (tmp_path / "t" / f"Date={FIRST}").iterdir()} == before


def test_keys_must_be_present_and_unique(spark, target, tmp_path):
    twice = target.unionByName(target)
    with pytest.raises(GateError):
        keyed.create_keyed_table(twice, str(tmp_path / "a"), ["k"])
    with pytest.raises(GateError):
        keyed.upsert_table(spark, str(tmp_path / "b"), twice, ["k"])
    with pytest.raises(GateError):
        keyed.create_keyed_table(
            spark.createDataFrame([(None, 1)], "k int, v int"), str(tmp_path / "c"), ["k"])


def test_other_read_failures_are_not_swallowed(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception) as caught:
        readers.path_exists(spark, str(tmp_path / "t"))
    assert not isinstance(caught.value, AnalysisException)


def test_a_day_that_is_there_is_not_computed_again(spark, tmp_path):
    path = str(tmp_path / "t")
    for value in (1, 2):
        writers.append_new_days(days(spark, FIRST, LAST, value), path, day=FIRST)
    assert held(spark, path) == [(FIRST, 1)]
    broken = days(spark, FIRST, LAST).withColumn("v", F.raise_error(F.lit("computed")).cast("int"))
    writers.append_new_days(broken, path, day=FIRST)
    assert writers.holds_day(spark, path, FIRST) and not writers.holds_day(spark, path, LAST)
