import math

import pytest

from tidemark.operators import cleaning

SCHEMA = "id int, v double, n string, allnull string"


@pytest.fixture
def dirty(spark):
    rows = [(1, 1.0, "a", None), (2, math.nan, "b", None), (3, None, "c", None),
            (3, None, "c", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_copies_are_dropped(dirty):
    assert cleaning.drop_duplicate_rows(dirty).count() == 3


def test_empty_column_is_dropped_and_may_be_kept(dirty):
    assert cleaning.drop_null_columns(dirty).columns == ["id", "v", "n"]
    assert cleaning.drop_null_columns(dirty, keep=["allnull"]).columns == dirty.columns


def test_null_and_nan_rows_are_dropped(dirty):
    rows = cleaning.drop_null_rows(dirty.drop("allnull")).collect()
    assert [r["id"] for r in rows] == [1]


def test_clean_equals_the_three_steps_in_order(dirty):
    stepwise = cleaning.drop_null_rows(
        cleaning.drop_null_columns(cleaning.drop_duplicate_rows(dirty)))
    cleaned = cleaning.clean(dirty)
    assert cleaned.columns == stepwise.columns
    assert cleaned.collect() == stepwise.collect()


def test_empty_frame_keeps_its_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cleaning.drop_null_columns(empty).columns == empty.columns
    assert cleaning.clean(empty).count() == 0


def test_null_profile_counts_nulls_but_not_nan(dirty):
    found = {r["column"]: (r["n_rows"], r["n_null"]) for r in cleaning.null_profile(dirty).collect()}
    assert found == {"id": (4, 0), "v": (4, 2), "n": (4, 0), "allnull": (4, 4)}


def test_smallest_row_per_key_survives_any_partitioning(spark):
    df = spark.createDataFrame([(1, 5, "z"), (1, 4, "y"), (1, 4, "x"), (2, 9, "w")],
                               "k int, a int, b string")
    for n in (1, 4):
        rows = cleaning.drop_duplicate_keys(df.repartition(n), ["k"]).collect()
        assert sorted(map(tuple, rows)) == [(1, 4, "x"), (2, 9, "w")]


def test_key_only_frame(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    assert cleaning.drop_duplicate_keys(df, ["k"]).count() == 1
