import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark import durable as d
from tidemark.operators import sales, synth
from tidemark.operators.quality import GateError
from tidemark.plans import flows
from tidemark.sources import readers, writers

KEYS = ["house_id", "Date"]
START, END = dt.date(2022, 12, 7), dt.date(2022, 12, 9)


@pytest.fixture(scope="module")
def house(spark):
    """A table in the shape of the daily one, with a price that is a line."""
    return spark.range(400).select(
        (F.col("id") + 1).cast("int").alias("house_id"),
        (F.col("id") % 37).cast("double").alias("rooms"),
        (F.col("id") % 11).cast("int").alias("age"),
        F.element_at(F.array(F.lit("<1H OCEAN"), F.lit("INLAND"), F.lit("NEAR BAY")),
                     (F.col("id") % 3 + 1).cast("int")).alias("ocean_proximity"),
        (F.lit(1000.0) + 50 * (F.col("id") % 37) - 3 * (F.col("id") % 11)
         + 20 * F.pow(F.col("id") % 3, F.lit(2))).alias("median_house_value"),
        F.lit(dt.date(2022, 11, 30)).alias("Date"),
    )


def test_generated_rows_follow_the_profile(spark, house):
    profile = synth.profile_table(house, exclude=KEYS)
    rows = synth.synth_rows(spark, profile, [START, END], rows_per_day=500, seed=1)
    assert rows.columns == ["house_id", "rooms", "age", "ocean_proximity", "median_house_value",
                            "Date"]
    assert dict(rows.dtypes)["age"] == "int"
    per_day = {r["Date"]: r for r in rows.groupBy("Date").agg(
        F.count("*").alias("n"), F.min("house_id").alias("lo"), F.max("house_id").alias("hi"),
        F.count_distinct("house_id").alias("ids"), F.min("rooms").alias("rmin"),
        F.max("rooms").alias("rmax"), F.collect_set("age").alias("ages"),
        F.collect_set("ocean_proximity").alias("places")).collect()}
    assert set(per_day) == {START, END}
    for r in per_day.values():
        assert (r["n"], r["lo"], r["hi"], r["ids"]) == (500, 1, 500, 500)
        assert 0 <= r["rmin"] and r["rmax"] <= 36
        assert set(r["ages"]) == set(range(11))
        assert set(r["places"]) == {"<1H OCEAN", "INLAND", "NEAR BAY"}
    again = synth.synth_rows(spark, profile, [START, END], rows_per_day=500, seed=1)
    assert rows.repartition(3).exceptAll(again).count() == 0
    other = synth.synth_rows(spark, profile, [START, END], rows_per_day=500, seed=2)
    assert rows.exceptAll(other).count() > 900


def test_columns_of_any_number_of_values(spark):
    """A column of 100,000 values beside one of two: every row has one of them, the same however they are joined."""
    df = spark.range(100_000).select(
        "id", F.concat(F.lit("v"), "id").alias("many"), F.when(F.col("id") % 2 == 0, "even").alias("few"))
    profile = synth.profile_table(df, exclude=["id"])
    assert profile.sizes == {"many": 100_000, "few": 2}
    rows = synth.synth_rows(spark, profile, [START, END], rows_per_day=20_000, id_col="id")
    seen = rows.agg(F.count("*").alias("n"), F.count_distinct("many").alias("many"), F.collect_set(F.coalesce("few", F.lit("-"))).alias("few")).first()
    assert seen["n"] == 40_000 and seen["many"] > 30_000 and set(seen["few"]) == {"even", "-"}
    assert rows.join(df, "many", "left_anti").count() == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        again = synth.synth_rows(spark, profile, [START, END], rows_per_day=20_000, id_col="id")
        assert rows.exceptAll(again).count() == 0 == again.exceptAll(rows).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nulls_and_empty_columns_in_a_profile(spark):
    df = spark.createDataFrame(
        [(1, None, None, "a", True), (2, None, None, None, False)],
        "id int, n double, e string, s string, b boolean")
    profile = synth.profile_table(df, exclude=["id"])
    rows = synth.synth_rows(spark, profile, [START], rows_per_day=100, id_col="id").collect()
    assert {r["n"] for r in rows} == {None} == {r["e"] for r in rows}
    assert {r["s"] for r in rows} == {"a", None}
    assert {r["b"] for r in rows} == {True, False}
    with pytest.raises(ValueError):
        synth.synth_rows(spark, profile, [])


def test_house_price_flow(spark, house, tmp_path):
    raw, enriched, feats, store, models, scores = (
        str(tmp_path / n) for n in ("raw", "enriched", "features", "store", "models", "scores"))

    assert flows.house_raw(spark, house, raw, START, END, rows_per_day=300) == [
        START, dt.date(2022, 12, 8), END]
    assert flows.house_raw(spark, house, raw, START, END, rows_per_day=300) == []

    checks = flows.house_enriched(spark, raw, enriched, KEYS).collect()
    assert checks and all(r["success"] for r in checks)
    flows.house_raw(spark, house, raw, dt.date(2022, 12, 10), rows_per_day=300)
    for _ in range(2):
        flows.house_enriched(spark, raw, enriched, KEYS, day=dt.date(2022, 12, 10))
    daily = readers.read_table(spark, enriched)
    assert daily.count() == 1200

    def build():
        flows.build_features(spark, house, daily, feats, store, KEYS, "ocean_proximity",
                             "median_house_value",
                             categories=["<1H OCEAN", "INLAND", "NEAR BAY"])
        return readers.read_table(spark, store)

    table = build()
    assert set(table.columns) == {"house_id", "rooms", "age", "Date", "1HOCEAN", "INLAND",
                                  "NEARBAY"}
    assert table.count() == 1600
    assert build().count() == 1600

    training = str(tmp_path / "training")
    flows.training_table(house, daily, training, KEYS, "house_id", "median_house_value")
    assert readers.read_table(spark, training).count() == 1600
    for _ in range(2):
        flows.training_table(house, None, training, KEYS, "house_id", "median_house_value",
                             mode="historical")
    labels = readers.read_table(spark, training)
    assert labels.count() == 400
    columns = [c for c in table.columns if c not in KEYS]
    version, evaluation = flows.train(
        spark, labels, table, KEYS, "median_house_value", models, "price")
    assert version == 1
    row = evaluation.first()
    assert row["accepted"] and row["rmse"] < 1e-6
    version, _ = flows.train(spark, labels, table, KEYS, "median_house_value", models, "price")
    assert version == 2

    for _ in range(2):
        flows.score_and_append(spark, table, models, "price", scores, day=END)
    scored = readers.read_table(spark, scores)
    assert scored.count() == 300 and set(scored.columns) == {*KEYS, *columns, "predictions"}
    flows.score_and_append(spark, table, models, "price", scores, start=START, end=END)
    assert readers.read_table(spark, scores).count() == 900

    verdict = flows.monitor_drift(table, labels, KEYS, ["1HOCEAN", "INLAND", "NEARBAY"], END)
    assert verdict.first()["n_features"] == 5
    same = flows.monitor_drift(
        table, labels, KEYS, ["1HOCEAN", "INLAND", "NEARBAY"], dt.date(2022, 11, 30))
    assert not same.first()["is_drift"]

    stable = flows.monitor_model(spark, labels, table, readers.read_table(spark, scores), KEYS,
                                 "median_house_value", models, "price")
    assert stable.first()["stable"]


def test_feature_gate_stops_before_anything_is_written(spark, house, tmp_path):
    broken = house.withColumn("rooms", F.lit("many"))
    with pytest.raises(GateError):
        flows.build_features(spark, broken, broken, str(tmp_path / "f"), str(tmp_path / "s"), KEYS,
                             "ocean_proximity", "median_house_value")
    assert not os.path.exists(tmp_path / "f") and not os.path.exists(tmp_path / "s")


def star(spark):
    """Two channels of a tiny star; every fact row has one copy."""
    money = "decimal(7,2)"
    facts = {}
    for prefix, outlet in (("ss", "store_sk"), ("ws", "web_site_sk")):
        names = ["sold_date_sk", "item_sk", outlet, "ext_wholesale_cost", "ext_list_price",
                 "ext_ship_cost", "ext_tax", "coupon_amt", "net_paid", "net_paid_inc_tax"]
        rows = [(1, 1, 1, 1.0, 2.0, 0.5, 0.1, 0.0, 2.0, 2.1), (1, 1, 1, 3.0, 4.0, 0.5, 0.2, 1.0, 3.0, 3.2),
                (1, 9, 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), (None, 1, 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
        df = spark.createDataFrame(rows, ", ".join(
            f"{prefix}_{n} {'int' if n.endswith('_sk') else 'double'}" for n in names))
        df = df.withColumns({f"{prefix}_{n}": F.col(f"{prefix}_{n}").cast(money)
                             for n in names if not n.endswith("_sk")})
        df = df.withColumn(f"{prefix}_quantity", F.lit(2)).withColumn(
            f"{prefix}_empty", F.lit(None).cast("string"))
        if prefix == "ss":
            df = df.drop("ss_ext_ship_cost")
        facts[prefix] = df.unionByName(df)
    return {
        "store_sales": facts["ss"],
        "web_sales": facts["ws"],
        "date_dim": spark.createDataFrame(
            [(1, dt.date(2001, 5, 1), 2001, "2001Q2")],
            "d_date_sk int, d_date date, d_year int, d_quarter_name string"),
        "item": spark.createDataFrame(
            [(1, "b", "m", "p")],
            "i_item_sk int, i_brand string, i_manufact string, i_product_name string"),
        "store": spark.createDataFrame([(1, "corner")], "s_store_sk int, s_store_name string"),
        "web_site": spark.createDataFrame([(1, "site_0")], "web_site_sk int, web_name string"),
    }


def test_sales_flow(spark, tmp_path):
    tables = star(spark)
    raw, enriched, cube = (str(tmp_path / n) for n in ("raw", "enriched", "cube"))
    flows.sales_raw(tables, raw, run_date="2024-02-01")
    flows.sales_enriched(spark, raw, enriched, list(tables))
    assert "ss_empty" not in readers.read_table(spark, f"{enriched}/store_sales").columns
    checks = flows.sales_curated(spark, enriched, cube).collect()
    assert len(checks) == 25 and all(r["success"] for r in checks)
    rows = {r["source"]: r for r in readers.read_table(spark, cube).collect()}
    assert set(rows) == {"Store", "Web"}
    for source, outlet, ship in (("Store", "corner", 0.0), ("Web", "site_0", 1.0)):
        r = rows[source]
        assert (r["store_name"], r["brand"], r["year"]) == (outlet, "b", 2001)
        assert r["total_sold_quantity"] == 4 and r["total_ext_ship_cost"] == ship
        assert float(r["total_net_paid"]) == 5.0
        assert r["partition_date"] == dt.date(2024, 2, 1)


def test_sales_checks_are_recorded(spark, tmp_path):
    rows = [(1, 1, 10, 5.0), (1, 1, 10, None), (2, None, 9, 1.0)]
    df = spark.createDataFrame(
        rows, "ws_item_sk int, ws_order_number int, ws_promo_sk int, ws_net_profit double")
    writers.write_table(df, str(tmp_path / "web_sales"), partition_by=None)
    flows.sales_checks(spark, str(tmp_path), ["web_sales"], "raw", str(tmp_path / "results"))
    found = {(r["rule"], r["column"]): r for r in spark.read.parquet(str(tmp_path / "results")).collect()}
    assert len(found) == 5
    assert found["unique", "ws_item_sk,ws_order_number"]["unexpected_count"] == 2
    assert not found["not_null", "ws_order_number"]["success"]
    assert found["not_null", "ws_net_profit"]["threshold"] == "mostly=0.9"
    assert not found["not_null", "ws_net_profit"]["success"]
    assert found["value_length", "ws_promo_sk"]["success"]
    with pytest.raises(GateError, match="not_null on ws_order_number"):
        flows.sales_checks(spark, str(tmp_path), ["web_sales"], "raw", str(tmp_path / "results"),
                           gate=True)
    assert spark.read.parquet(str(tmp_path / "results")).count() == 10


def test_totals_by_other_keys(spark):
    lines = sales.sales_lines(**{k: v if not k.endswith("_sales") else
                                 writers.stamp(v, "2024-02-01") for k, v in star(spark).items()})
    rows = sales.sales_totals(lines, ["brand"]).collect()
    assert len(rows) == 1 and rows[0]["total_sold_quantity"] == 16


class _Cluster:
    """A session as the folder rule sees it: not local, nothing configured."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_must_name_its_shared_folder(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        d.shared_folder(_Cluster)
    assert d.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_broadcast_only_within_the_limit(spark):
    df = d.durable(spark.range(50))
    hinted = spark.range(9).join(d.broadcast_within(df, 50), "id")
    plain = spark.range(9).join(d.broadcast_within(df, 49), "id")
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()
