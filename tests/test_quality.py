import datetime as dt

import pytest

from tidemark.operators import quality as q
from tidemark.operators import suites


@pytest.fixture
def keys(spark):
    rows = [(1, 1), (1, 1), (2, None), (2, None), (None, None), (None, None), (3, 4)]
    return spark.createDataFrame(rows, "a int, b int")


def run(df, *rules):
    return {(r["rule"], r["column"], r["threshold"]): r
            for r in q.run_suite(df, rules, suite="s", table="t").collect()}


def test_unique_counts_all_copies_and_skips_all_null_keys(keys):
    (row,) = run(keys, q.Unique(("a", "b"))).values()
    assert (row["element_count"], row["unexpected_count"], row["success"]) == (7, 4, False)
    assert row["unexpected_percent"] == 57.14


def test_not_null_with_mostly(keys):
    found = run(keys, q.NotNull("a"), q.NotNull("a", 0.7), q.NotNull("a", 0.72))
    assert [r["success"] for r in found.values()] == [False, True, False]
    assert {r["unexpected_count"] for r in found.values()} == {2}


def test_lengths_count_digits_and_ignore_nulls(spark):
    df = spark.createDataFrame([(5,), (50,), (500,), (None,)], "n int")
    (row,) = run(df, q.ValueLength("n", 1, 2)).values()
    assert (row["unexpected_count"], row["element_count"]) == (1, 4)
    (row,) = run(df, q.ValueRange("n", 5, 50)).values()
    assert (row["unexpected_count"], row["success"]) == (1, False)


def test_empty_table_passes_without_division_by_zero(spark):
    df = spark.createDataFrame([], "a int")
    found = run(df, q.NotNull("a", 0.9), q.Unique(("a",)), q.ValueLength("a", 0, 1), q.RowCount(0))
    assert len(found) == 4
    assert all(r["success"] and r["unexpected_percent"] == 0.0 for r in found.values())


def test_an_absent_column_fails_and_the_others_are_checked(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    rules = [q.NotNull("gone"), q.NotNull("b"), q.Unique(("a", "gone")), q.Unique(("a",)), q.ValueRange("a", 1, 2), q.RowCount(2),
             q.HasColumn("gone"), q.ValueLength("also.gone", 1, 2)]
    found = run(df, *rules)
    assert {(k[0], k[1]): (r["unexpected_count"], r["success"]) for k, r in found.items()} == {
        ("not_null", "gone"): (None, False), ("not_null", "b"): (1, False), ("unique", "a,gone"): (None, False), ("unique", "a"): (0, True),
        ("value_range", "a"): (0, True), ("row_count", "*"): (0, True), ("has_column", "gone"): (1, False), ("value_length", "also.gone"): (None, False)}
    with pytest.raises(q.GateError, match="not_null on gone: absent"):
        q.require_passed(q.run_suite(df, rules, suite="s", table="t"))
    (row,) = run(df, q.NotNull("gone")).values()
    assert not row["success"] and row["unexpected_percent"] is None


def test_shape_and_schema(spark):
    df = spark.createDataFrame([(1, 1.5, dt.date(2024, 1, 1), "x")], "i int, d double, t date, s string")
    found = run(df, q.RowCount(2), q.ColumnCount(4), q.HasColumn("i"), q.HasColumn("gone"),
                q.TypeIn("d"), q.TypeIn("s"), q.TypeIn("t", ("DateType",)), q.TypeIn("gone"))
    assert [r["success"] for r in found.values()] == [
        False, True, True, False, True, False, True, False]


def test_all_row_rules_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    rules = [q.NotNull("id"), q.ValueRange("id", 0, 5), q.RowCount(10), q.ValueLength("id", 0, 1)]
    plan = q.run_suite(spark.read.parquet(path), rules, suite="s", table="t")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def test_gate_names_what_failed(keys):
    results = q.run_suite(keys, [q.NotNull("a"), q.RowCount(7)], suite="s", table="t")
    with pytest.raises(q.GateError) as caught:
        q.require_passed(results)
    assert caught.value.failures == ["t: not_null on a: 2 of 7"]
    q.require_passed(q.run_suite(keys, [q.RowCount(7)], suite="s", table="t"))


def test_a_type_failure_gates_features(spark):
    df = spark.createDataFrame([(1, "x", dt.date(2024, 1, 1))], "house_id long, f string, Date date")
    rules = suites.feature_suite(df.columns, ["house_id", "Date"])
    with pytest.raises(q.GateError, match="type_in on f"):
        q.require_passed(q.run_suite(df, rules, suite="features", table="f"))


def test_results_are_kept(spark, keys, tmp_path):
    path = str(tmp_path / "results")
    for day in ("2024-02-01", "2024-02-02"):
        q.record_results(q.run_suite(keys, [q.RowCount(7)], suite="s", table="t"), path, day)
    kept = spark.read.parquet(path)
    assert kept.columns == [*q.RESULT_COLUMNS, "run_date"]
    assert sorted(r["run_date"] for r in kept.collect()) == [dt.date(2024, 2, 1), dt.date(2024, 2, 2)]


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("if(id % 3 = 0, -1, id) as k")
    (row,) = run(df, q.Unique(("k",))).values()
    assert row["unexpected_count"] == 33_334


def test_suites_cover_the_sales_tables():
    assert set(suites.SALES_SUITES) == {
        "store_sales", "catalog_sales", "web_sales", "inventory", "web_returns",
        "catalog_returns"}
    assert len(suites.curated_suite()) == 15 + 8 + 2
