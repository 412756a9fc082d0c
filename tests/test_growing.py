"""Tables that grow: stored schemas, widening appends, pruned upserts, registered categories."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import categories
from tidemark.operators.quality import GateError
from tidemark.plans import flows
from tidemark.sources import keyed, readers, schema, writers

KEYS = ["id", "Date"]
DAYS = [dt.date(2022, 12, d) for d in range(7, 12)]


def rows(spark, day, columns="", n=3):
    return spark.range(n).selectExpr("id", f"date '{day}' as Date", *([columns] if columns else []))


@pytest.mark.parametrize("old, new, wide", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "double", "double"), ("int", "double", "double"),
    ("bigint", "double", None), ("int", "float", None), ("string", "int", None), ("void", "date", "date"),
    ("decimal(5,2)", "decimal(6,4)", "decimal(7,4)"), ("int", "decimal(12,2)", "decimal(12,2)"), ("int", "decimal(5,2)", None),
    ("decimal(38,0)", "decimal(38,10)", None), ("date", "timestamp", None),
])
def test_wider(spark, old, new, wide):
    kind = lambda t: T._parse_datatype_string(t) if t != "void" else T.NullType()
    assert schema.wider(kind(old), kind(new)) == (wide and kind(wide))


def test_merged_names_all_that_does_not_widen(spark):
    a, b = (T._parse_datatype_string(s) for s in ("a int, b string, c date", "b int, c string, d int"))
    with pytest.raises(ValueError, match="b: string and int, c: date and string"):
        schema.merged(a, b)
    with pytest.raises(ValueError, match="case"):
        schema.merged(a, T._parse_datatype_string("B string"))


def test_append_widens_and_keeps_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_new_days(rows(spark, DAYS[0], "1 as v"), path, widen=True)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    writers.append_new_days(rows(spark, DAYS[1], "5000000000 as v").withColumn("w", F.lit("x")), path, widen=True)
    writers.append_new_days(rows(spark, DAYS[2]), path, widen=True)
    writers.append_new_days(rows(spark, DAYS[1], "7L as v"), path, widen=True)  # held already
    table = readers.read_table(spark, path)
    assert dict(table.dtypes) == {"id": "bigint", "v": "bigint", "w": "string", "Date": "date"}
    got = {(r.Date, r.v, r.w) for r in table.collect()}
    assert got == {(DAYS[0], 1, None), (DAYS[1], 5_000_000_000, "x"), (DAYS[2], None, None)} and table.count() == 9
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    with pytest.raises(ValueError, match="v: bigint and string"):
        writers.append_new_days(rows(spark, DAYS[3], "'x' as v"), path, widen=True)
    assert len(schema._versions(spark, path)) == 1 and readers.read_table(spark, path).count() == 9
    with pytest.raises(ValueError, match="extra"):
        writers.append_new_days(rows(spark, DAYS[3], "1 as extra"), path)


def test_a_stored_version_is_not_written_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    first = T._parse_datatype_string("a int")
    schema.store(spark, path, first)
    (tmp_path / "t" / "_schema" / "v000002").mkdir()  # of a writer that has not finished
    assert schema.stored(spark, path) == first
    with pytest.raises(Exception, match="already exists"):
        schema.store(spark, path, first)


def test_empty_first_day_then_values(spark, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "enriched")
    days = [rows(spark, d, f"cast({'null' if i in (0, 2) else i} as double) as v") for i, d in enumerate(DAYS[:4])]
    for df in days:
        writers.write_table(df, raw, partition_by="Date", mode="append")
    for day in DAYS[:4] + DAYS[:4]:
        flows.house_enriched(spark, raw, path, KEYS, day)
    assert {(r.Date, r.v) for r in readers.read_table(spark, path).collect()} == {
        (DAYS[0], None), (DAYS[1], 1.0), (DAYS[2], None), (DAYS[3], 3.0)}


def test_upsert_reads_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in DAYS:
        writers.write_table(rows(spark, day, "1 as v"), path, partition_by="Date", mode="append")
    part = keyed.only_partitions(readers.read_table(spark, path), "Date", [DAYS[1], DAYS[3]])
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "Date" in filters and "IN (" in filters
    assert {r[0] for r in part.select("Date").distinct().collect()} == {DAYS[1], DAYS[3]}
    keyed.upsert_table(spark, path, rows(spark, DAYS[1], "9L as v", n=4).withColumn("w", F.lit("n")), KEYS, partition_by="Date")
    got = sorted((r.Date, r.id, r.v, r.w) for r in readers.read_table(spark, path).collect())
    assert got == sorted([(d, i, 1, None) for d in DAYS if d != DAYS[1] for i in range(3)] + [(DAYS[1], i, 9, "n") for i in range(4)])
    assert keyed.only_partitions(part, "Date", [None]).count() == 0


def test_upsert_of_all_partitions_keeps_every_column(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert_table(spark, path, spark.range(3).selectExpr("id", "1 as v"), ["id"])
    keyed.upsert_table(spark, path, spark.range(2, 4).selectExpr("id", "'b' as w"), ["id"])
    got = {tuple(r) for r in readers.read_table(spark, path).select("id", "v", "w").collect()}
    assert got == {(0, 1, None), (1, 1, None), (2, None, "b"), (3, None, "b")}


def test_categories_only_grow(spark, tmp_path):
    path = str(tmp_path / "r")
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "c string")
    assert categories.registered(spark, path, "c") == []
    assert categories.register(df("b", "z", None), "c", path) == ["b", "z"]
    assert categories.register(df("a", "z"), "c", path) == ["b", "z", "a"]
    assert categories.register(df(), "c", path) == ["b", "z", "a"]
    assert categories.registered(spark, path, "other") == []
    with pytest.raises(ValueError, match="more than 3"):
        categories.register(df("q"), "c", path, limit=3)
    with pytest.raises(ValueError, match="collide"):
        categories.register(df("< b"), "c", path)


def test_feature_increments(spark, tmp_path):
    feats, store = str(tmp_path / "f"), str(tmp_path / "s")
    table = lambda day, *kinds: spark.createDataFrame(
        [(i, float(i), k, 1.0, day) for i, k in enumerate(kinds)], "id int, x double, kind string, y double, Date date")
    build = lambda old, new, **o: flows.build_features(spark, old, new, feats, store, KEYS, "kind", "y", **o)
    old = table(DAYS[0], "B", "C")
    build(old, old.limit(0))
    build(old, table(DAYS[1], "C", "A", "A"))
    build(old, table(DAYS[1], "C", "A", "A"))
    daily = table(DAYS[2], "D").unionAll(table(DAYS[3], "E"))
    build(old, daily, mode="today", day=DAYS[2])
    for path in (feats, store):
        got = flows.read_features(spark, path, flows.registry_of(feats), "kind")
        assert set(got.columns) == {"id", "x", "Date", "A", "B", "C", "D"}
        assert sorted((r.Date, r.id, "".join(c for c in "ABCD" if r[c])) for r in got.collect()) == [
            (DAYS[0], 0, "B"), (DAYS[0], 1, "C"), (DAYS[1], 0, "C"), (DAYS[1], 1, "A"), (DAYS[1], 2, "A"), (DAYS[2], 0, "D")]
    with pytest.raises(ValueError, match="mode"):
        build(old, daily, mode="some")


def test_a_run_that_stopped_before_the_append_is_made_good(spark, tmp_path, monkeypatch):
    feats, store = str(tmp_path / "f"), str(tmp_path / "s")
    df = spark.createDataFrame([(1, "B", 1.0, DAYS[0])], "id int, kind string, y double, Date date")

    def stop(*_, **__):
        raise GateError("stopped")

    with monkeypatch.context() as m:
        m.setattr(writers, "append_new_days", stop)
        with pytest.raises(GateError):
            flows.build_features(spark, df, df.limit(0), feats, store, KEYS, "kind", "y")
    flows.build_features(spark, df, df.limit(0), feats, store, KEYS, "kind", "y")
    assert readers.read_table(spark, feats).count() == readers.read_table(spark, store).count() == 1
