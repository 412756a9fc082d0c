"""A key with a third of all rows: split by adaptive execution, results whole."""

import os
import re
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.operators import cleaning, drift, features, sales
from tidemark.sources import keyed, writers
from tests.test_flows import star

ROWS = 240_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def shuffled(spark):
    """Joins shuffle, and what counts as a large partition is small."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture
def hot(spark):
    """A third of the rows have key 7, the rest spread over 3000 keys."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000)
    return spark.range(0, ROWS, 1, 8).select(
        key.cast("int").alias("k"), F.col("id").alias("n"), F.md5(F.col("id").cast("string")).alias("pad"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString().split("== Initial Plan ==")[0]


def test_feature_lookup_splits_a_hot_key(spark, shuffled, hot):
    table = spark.range(3000).selectExpr("cast(id as int) as k", "id * 2 as f")
    joined = features.lookup_features(hot, table, ["k"], keep_keys=True)
    assert re.search(r"SortMergeJoin\(skew=true\)", final_plan(joined))
    assert joined.agg(F.count("f"), F.sum("f")).first() == (
        ROWS, hot.agg(F.sum(F.col("k") * 2)).first()[0])


def test_left_reference_splits_a_hot_training_key(spark, shuffled, hot):
    table = spark.range(4000).selectExpr("cast(id as int) as k", "id * 2 as f")
    rows = drift.reference_rows_left(table, hot, ["k"])
    assert "skew=true" in final_plan(rows)
    assert rows.count() == ROWS + 4000 - hot.select("k").distinct().count()


def test_sales_lines_split_a_hot_item(spark, shuffled):
    tables = star(spark)
    item = spark.range(3000).selectExpr(
        "cast(id as int) as i_item_sk", "concat('b', id % 5) as i_brand", "'m' as i_manufact",
        "concat('p', id) as i_product_name")
    fact = spark.range(0, ROWS, 1, 8).selectExpr(
        "1 as ss_sold_date_sk", "cast(if(id % 3 = 0, 7, id % 3000) as int) as ss_item_sk",
        "1 as ss_store_sk", "1 as ss_quantity", "cast(rand(1) * 100 as decimal(7,2)) as ss_ext_wholesale_cost",
        *[f"cast(1.25 as decimal(7,2)) as ss_{m}" for m in (
            "ext_list_price", "ext_tax", "coupon_amt", "net_paid", "net_paid_inc_tax")])
    lines = sales.channel_lines(writers.stamp(fact, "2024-02-01"), tables["date_dim"], item,
                                tables["store"], sales.STORE)
    assert "skew=true" in final_plan(lines)
    row = sales.sales_totals(lines, ["source"]).first()
    assert row["total_sold_quantity"] == ROWS and float(row["total_net_paid"]) == ROWS * 1.25


def test_copies_of_one_row_are_combined_before_the_shuffle(spark, hot):
    same = hot.select("k", F.when(F.col("k") == 7, 0).otherwise(F.col("n")).alias("n"))
    plan = cleaning.drop_duplicate_rows(same)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
    assert cleaning.drop_duplicate_rows(same).count() == same.where("k <> 7").count() + 1
    kept = cleaning.drop_duplicate_keys(hot, ["k"])
    assert kept.count() == hot.select("k").distinct().count()
    assert kept.where("k = 7").first()["n"] == 0


def test_upsert_into_a_large_table(spark, shuffled):
    target = spark.range(50_000).selectExpr("id as k", "0 as v")
    source = spark.range(25_000, 75_000).selectExpr("id as k", "1 as v")
    result = keyed.upsert_by_key(target, source, ["k"])
    assert result.agg(F.count("k"), F.count_distinct("k"), F.sum("v")).first() == (75_000, 75_000, 50_000)


def test_the_cube_sums_few_lines_in_a_task(spark, monkeypatch):
    """Lines are dealt out before they are summed, a group of very many lines too; the totals are the same."""
    tables = star(spark)
    day = F.to_date(F.lit("2024-02-01"))
    for prefix, name in (("ss", "store_sales"), ("ws", "web_sales")):
        more = spark.range(2_000).select(F.col("id").cast("int").alias("i")).crossJoin(tables[name].limit(1))
        tables[name] = more.withColumn(f"{prefix}_net_paid", F.col("i")).withColumn("partition_date", day).drop("i")
    want = sales.sales_totals(sales.sales_lines(**tables)).collect()
    monkeypatch.setattr(sales, "LINES_A_TASK", 500)
    got = sales.sales_cube(**tables)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want} and len(want) == 2
    plan = final_plan(got)
    assert re.search(r"hashpartitioning\([^)]*net_paid[^)]*, 8\), REPARTITION_BY_NUM", plan)
    assert plan.index("REPARTITION_BY_NUM") > plan.rindex("HashAggregate")  # partial sums come after


def shuffle_bytes(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(os.path.getsize(f"{at}/{name}") for folder in disk.localDirs()
               for at, _, names in os.walk(folder.getPath()) for name in names if name.startswith("shuffle"))


def many_sales(spark, key="int"):
    """6,000 lines of 200 dates, 50 items and 2 outlets, a sixth without a date or an item; names and keys repeat."""
    tables = star(spark)
    line = spark.range(0, 6_000, 1, 4)
    for prefix, outlet, name in (("ss", "store_sk", "store_sales"), ("ws", "web_site_sk", "web_sales")):
        tables[name] = line.select(
            F.to_date(F.lit("2024-02-01")).alias("partition_date"),
            F.when(F.col("id") % 6 > 0, F.col("id") % 200).cast(key).alias(f"{prefix}_sold_date_sk"),
            F.when(F.col("id") % 7 > 0, F.col("id") % 50).cast("int").alias(f"{prefix}_item_sk"),
            (F.col("id") % 2).cast("int").alias(f"{prefix}_{outlet}"), F.lit(2).alias(f"{prefix}_quantity"),
            *[F.when(F.col("id") % 11 > 0, F.col("id") % 1000).cast("decimal(7,2)").alias(f"{prefix}_{m}")
              for m in sales.MEASURES.values() if m != "quantity" and (prefix == "ws" or "ship" not in m)])
    day = F.date_add(F.lit("2001-01-01"), (F.col("k") % 20).cast("int"))
    tables["date_dim"] = spark.range(205).select((F.col("id") % 200).alias("k")).select(
        F.col("k").alias("d_date_sk"), day.alias("d_date"), F.year(day).alias("d_year"),
        F.when(F.col("k") % 3 > 0, "2001Q1").alias("d_quarter_name"))
    tables["item"] = spark.range(50).selectExpr(
        "id as i_item_sk", "concat('b', id % 5) as i_brand", "if(id % 4 = 0, null, 'm') as i_manufact",
        "concat('p', id % 10) as i_product_name")
    for name, outlet, label in (("store", "s_store_sk", "s_store_name"), ("web_site", "web_site_sk", "web_name")):
        tables[name] = spark.range(2).select(F.col("id").cast("int").alias(outlet), F.lit("x").alias(label))
    return tables


@pytest.mark.parametrize("key, a_cell", [("int", 4_000), ("string", 400)])
def test_the_cube_of_many_lines_by_cells(spark, shuffled, monkeypatch, key, a_cell):
    """The same rows and types by 4 and by 16 cells, from keys of one type or two."""
    tables = many_sales(spark, key)
    want = sales.sales_cube(**tables)
    monkeypatch.setattr(sales, "LINES_A_CELL", a_cell)
    monkeypatch.setattr(sales, "LINES_A_TASK", 100)
    got = sales.sales_cube(**tables)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and want.count() > 100


def test_the_cube_of_many_lines_without_matches(spark, monkeypatch):
    monkeypatch.setattr(sales, "LINES_A_CELL", 400)
    tables = many_sales(spark)
    assert sales.sales_cube(**{**tables, "item": tables["item"].limit(0)}).collect() == []


def test_the_cube_of_many_lines_leaves_little_on_disk(spark, shuffled, monkeypatch, tmp_path):
    """Shuffles of all joins and sums lay on disk to the end; now a cell's go when its sums are written."""
    tables = many_sales(spark)
    most, before = [], shuffle_bytes(spark)
    write = DataFrameWriter.parquet
    def watched(*args, **options):
        write(*args, **options)
        most.append(shuffle_bytes(spark) - before)
    sales.sales_cube(**tables).write.parquet(str(tmp_path / "whole"))
    whole = shuffle_bytes(spark) - before
    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    monkeypatch.setattr(sales, "LINES_A_CELL", 400)
    before = shuffle_bytes(spark)
    cube = sales.sales_cube(**tables)
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and len(most) == 16 + 8 and max(most) < whole / 3
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
