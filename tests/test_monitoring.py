import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import chi_square_p_value, ks_p_value, sign_flags, unit_hash
from tidemark.operators import drift, features, scoring, stability, training
from tidemark.operators.running import running_sums
from tidemark.plans import flows


@pytest.fixture
def line(spark):
    """y = 3 + 2a - b, exactly."""
    rows = [(i, float(i), float(i * i % 7), 3.0 + 2 * i - (i * i % 7)) for i in range(20)]
    return spark.createDataFrame(rows, "k int, a double, b double, y double")


def test_exact_line_is_recovered(line):
    model = training.fit_linear(line, ["a", "b"], "y")
    assert model.coefficients == pytest.approx((2, -1), abs=1e-9)
    assert model.intercept == pytest.approx(3, abs=1e-9)
    row = training.errors(scoring.score(line, model), "y").first()
    assert row["rmse"] == pytest.approx(0, abs=1e-9) and row["accepted"]


def test_far_away_columns_keep_their_digits(line):
    far = line.withColumn("a", F.col("a") + 1e9)
    assert training.fit_linear(far, ["a", "b"], "y").coefficients == pytest.approx((2, -1), abs=1e-6)


def test_dependent_indicators_get_the_smallest_solution(spark):
    """Both indicators always sum to one: effects +-2 around the mean."""
    rows = [(i % 2, 1 - i % 2, 10.0 + (2 if i % 2 else -2)) for i in range(10)]
    df = spark.createDataFrame(rows, "p int, q int, y double")
    model = training.fit_linear(df, ["p", "q"], "y")
    assert model.coefficients == pytest.approx((2, -2))
    assert model.intercept == pytest.approx(10)


def test_constant_feature_gets_no_weight(line):
    model = training.fit_linear(line.withColumn("c", F.lit(0.1)), ["a", "b", "c"], "y")
    assert model.coefficients == pytest.approx((2, -1, 0), abs=1e-9)


def test_fit_leaves_out_nulls_and_refuses_nothing(spark, line):
    holes = line.withColumn("a", F.when(F.col("k") % 4 > 0, F.col("a")))
    assert training.fit_linear(holes, ["a", "b"], "y").coefficients == pytest.approx((2, -1))
    with pytest.raises(ValueError):
        training.fit_linear(line.where("k < 0"), ["a"], "y")


def test_split_is_complete_disjoint_and_stable(spark):
    df = spark.range(1000).toDF("k")
    train, test = training.train_test_split(df, ["k"])
    a, b = ({r[0] for r in part.collect()} for part in (train, test))
    assert not a & b and len(a | b) == 1000 and 750 < len(a) < 850
    again, _ = training.train_test_split(df.repartition(7), ["k"])
    assert {r[0] for r in again.collect()} == a


def test_model_versions(spark, tmp_path):
    path = str(tmp_path / "models")
    first = training.LinearModel(("a",), (1.0,), 0.5)
    second = training.LinearModel(("a",), (-1.0,), 0.25)
    assert training.register_model(spark, path, "m", first, {"rmse": 1.0}) == 1
    assert training.register_model(spark, path, "other", first) == 1
    assert training.register_model(spark, path, "m", second) == 2
    assert training.load_latest(spark, path, "m") == second
    with pytest.raises(LookupError):
        training.load_latest(spark, path, "none")


def test_version_floor_is_one(spark):
    registry = spark.createDataFrame([("a", 0), ("b", 7), ("b", 3)], "model string, version int")
    assert {tuple(r) for r in training.latest_versions(registry).collect()} == {("a", 1), ("b", 7)}


def test_labels_by_mode(spark):
    schema = "house_id string, Date string, y int"
    historical = spark.createDataFrame([("1", "2022-12-01", 1), ("x", "2022-12-01", 1)], schema)
    daily = spark.createDataFrame([("2", "2022-12-07", 2), ("3", "2022-12-20", 3)], schema)

    def ids(**kwargs):
        labels = training.training_labels(
            historical, daily, ["house_id", "Date"], "house_id", "y", **kwargs)
        assert dict(labels.dtypes)["house_id"] == "bigint"
        return [r["house_id"] for r in labels.collect()]

    assert ids(mode="historical") == [1, None]
    assert ids(mode="all") == [1, None, 2, 3]
    assert ids(mode="range", start="2022-12-07", end="2022-12-14") == [1, None, 2]
    with pytest.raises(ValueError):
        ids(mode="some")


def test_sign_flags_leave_their_input(spark):
    df = spark.createDataFrame([([-5.0, 10.0, 6.0, -2.0, 0.0],)], "c array<double>")
    row = df.withColumn("f", sign_flags(F.col("c"))).first()
    assert row["f"] == [0, 1, 1, 0, 0]
    assert row["c"] == [-5.0, 10.0, 6.0, -2.0, 0.0]


def test_sign_comparison(spark):
    a = training.LinearModel(("p", "q"), (1.0, -2.0), 0.0)
    b = training.LinearModel(("p", "q"), (3.0, 0.0), 9.0)
    c = training.LinearModel(("p", "q"), (-1.0, -1.0), 0.0)
    assert stability.is_stable(stability.compare_signs(spark, a, b)).first()["stable"]
    assert not stability.is_stable(stability.compare_signs(spark, a, c)).first()["stable"]


def test_scored_rows_follow_training_rows(spark):
    trained = spark.createDataFrame([(1, 2.0, 3.0)], "k int, a double, y double")
    scored = spark.createDataFrame([(9.0, 2, 4.0)], "predictions double, k int, a double")
    rows = stability.refit_rows(trained, scored, "y").collect()
    assert [tuple(r) for r in rows] == [(1, 2.0, 3.0), (2, 4.0, 9.0)]


def test_one_hot_labels_and_nulls(spark):
    rows = [(1, "<1H OCEAN", 5), (2, "NEAR BAY", 6), (3, None, 7)]
    df = spark.createDataFrame(rows, "house_id int, place string, price int")
    encoded = features.one_hot(df, "place", "price")
    assert encoded.columns == ["house_id", "1HOCEAN", "NEARBAY"]
    assert sorted(map(tuple, encoded.collect())) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    assert [t for _, t in encoded.dtypes] == ["int", "int", "int"]


def test_one_hot_orders_categories(spark):
    rows = [("James", "M"), ("Michael", "M"), ("Rebecca", "F")]
    df = spark.createDataFrame(rows, "firstname string, gender string")
    encoded = features.one_hot(df, "gender")
    assert encoded.columns == ["firstname", "F", "M"]
    assert {tuple(r) for r in encoded.collect()} == {
        ("James", 0, 1), ("Michael", 0, 1), ("Rebecca", 1, 0)}
    fixed = features.one_hot(df, "gender", categories=["F", "M", "X"])
    assert fixed.columns == ["firstname", "F", "M", "X"]


def test_one_hot_refuses_what_it_cannot_name(spark):
    df = spark.createDataFrame([("a b",), ("ab",)], "c string")
    with pytest.raises(ValueError, match="collide"):
        features.one_hot(df, "c")
    with pytest.raises(ValueError, match="more than"):
        features.categories_of(spark.range(5).selectExpr("cast(id as string) c"), "c", limit=4)


def test_increment_without_a_table_is_everything(spark):
    df = spark.createDataFrame([("2022-12-07",)], "Date string")
    assert features.new_days_only(df, None, "Date").count() == 1
    assert features.new_days_only(df, df, "Date").count() == 0


def test_unmatched_labels_are_counted(spark):
    labels, known = spark.range(10).toDF("k"), spark.range(4).toDF("k").withColumn("f", F.lit(1))
    assert features.unmatched(labels, known, ["k"]).first()[0] == 6
    assert features.lookup_features(labels, known, ["k"], keep_keys=True).where(
        "f is null").count() == 6


def brute_force(ref, test):
    points = sorted(set(ref) | set(test))
    return max(abs(sum(x <= p for x in ref) / len(ref) - sum(x <= p for x in test) / len(test))
               for p in points)


def samples(spark, ref, test):
    return (spark.createDataFrame([(x,) for x in ref], "x double"),
            spark.createDataFrame([(x,) for x in test], "x double"))


@pytest.mark.parametrize("buckets", [2, 4, 64, 512])
def test_ks_equals_brute_force(spark, buckets):
    rng = random.Random(buckets)
    ref = [rng.gauss(0, 1) for _ in range(300)] + [0.25] * 150
    test = [rng.gauss(0.2, 1.3) for _ in range(200)] + [0.25] * 20 + [math.inf, -math.inf]
    row = drift.ks_drift(*samples(spark, ref, test), ["x"], buckets).first()
    assert row["statistic"] == pytest.approx(brute_force(ref, test), abs=1e-12)
    assert (row["n_ref"], row["n_test"]) == (450, 222)


def test_ks_of_a_sample_with_itself(spark):
    xs = [float(i * i % 101) for i in range(300)]
    for buckets in (2, 512):
        row = drift.ks_drift(*samples(spark, xs, xs), ["x"], buckets).first()
        assert (row["statistic"], row["p_value"]) == (0.0, 1.0)
    assert not drift.drift_verdict(drift.ks_drift(*samples(spark, xs, xs), ["x"])).first()["is_drift"]


def test_ks_of_a_shifted_sample(spark):
    xs = [float(i) for i in range(200)]
    tests = drift.ks_drift(*samples(spark, xs, [x + 50 for x in xs]), ["x"])
    assert tests.first()["statistic"] == pytest.approx(0.25)
    assert drift.drift_verdict(tests).first()["is_drift"]


def test_ks_ignores_nulls_and_nan_and_survives_an_empty_sample(spark):
    for buckets in (2, 512):
        row = drift.ks_drift(*samples(spark, [1.0, None, math.nan, 2.0], [1.0, 2.0]), ["x"], buckets).first()
        assert (row["n_ref"], row["n_test"], row["statistic"]) == (2, 2, 0.0)
        row = drift.ks_drift(*samples(spark, [1.0, 2.0], []), ["x"], buckets).first()
        assert (row["statistic"], row["p_value"]) == (0.0, 1.0)


def test_ks_with_a_hot_value(spark):
    ref = spark.range(30_000).selectExpr("if(id % 3 = 0, 7.5, id / 1000.0d) as x")
    test = spark.range(30_000).selectExpr("if(id % 3 = 0, 8.5, id / 1000.0d) as x")
    for buckets in (2, 64, 512):
        row = drift.ks_drift(ref, test, ["x"], buckets).first()
        assert row["statistic"] == pytest.approx(1 / 3, abs=1e-12)


def test_kolmogorov_tail(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.36,), (0.0,)], "d double")
    # n = m = 2 makes the scale factor 1.
    rows = df.select(ks_p_value(F.col("d"), F.lit(2), F.lit(2))).collect()
    assert [r[0] for r in rows] == pytest.approx([0.963945, 0.27, 0.049486, 1.0], abs=1e-6)


def test_chi_square_tail(spark):
    # Upper 5% points, and far tails, from tables of the distribution.
    points = [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05),
              (18.307038, 10, 0.05), (24.995790, 15, 0.05), (124.342113, 100, 0.05),
              (10.827566, 1, 0.001), (0.0, 1, 1.0), (5.0, 0, 1.0)]
    df = spark.createDataFrame(points, "x double, df int, p double")
    for r in df.withColumn("q", chi_square_p_value(F.col("x"), F.col("df"))).collect():
        assert r["q"] == pytest.approx(r["p"], abs=1e-7)
    far = spark.createDataFrame([(100.0, 1), (2000.0, 1500), (2000.0, 4)], "x double, df int")
    tails = [r[0] for r in far.select(chi_square_p_value(F.col("x"), F.col("df"))).collect()]
    assert tails[0] < 1e-15 and 0 < tails[1] < 1e-10 and tails[2] == 0.0


def test_chi_square_with_and_without_correction(spark):
    def rows(zeros, ones):
        return spark.createDataFrame([(0,)] * zeros + [(1,)] * ones + [(None,)], "f int")

    ref, test = rows(10, 20), rows(18, 12)
    plain = drift.chi_square_drift(ref, test, ["f"], correction=False).first()
    # 60 (10*12 - 20*18)^2 / (30*30*28*32), and with 30 off the difference.
    assert plain["statistic"] == pytest.approx(60 * 240**2 / (30 * 30 * 28 * 32))
    moved = drift.chi_square_drift(ref, test, ["f"]).first()
    assert moved["statistic"] == pytest.approx(60 * (240 - 30) ** 2 / (30 * 30 * 28 * 32))
    assert moved["df"] == 1 and moved["n_ref"] == 30


def test_left_reference_repeats_rows_like_a_left_join(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    trained = spark.createDataFrame([(1,), (1,), (2,), (9,)], "k int")
    left = drift.reference_rows_left(table, trained, ["k"]).collect()
    plain = table.join(trained, on="k", how="left").select("k", "v").collect()
    assert sorted(left) == sorted(plain)
    semi = drift.reference_rows(table, trained, ["k"]).collect()
    assert sorted(r["k"] for r in semi) == [1, 2]


def test_running_sums_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 4)], "g string, o int, x int")
    rows = running_sums(df, ["g"], ["o"], ["x"]).collect()
    assert sorted((r.g or "", r.o, r.x_upto) for r in rows) == [("", 1, 2), ("", 2, 5), ("a", 1, 4)]


def test_running_sums_over_slices(spark):
    df = spark.range(1000).selectExpr("id % 3 as g", "id as o", "id % 7 as x").repartition(5)
    for by in (["g"], []):
        rows = running_sums(df, by, ["o"], ["x"]).collect()
        total = {}
        assert len(rows) == 1000
        for r in sorted(rows, key=lambda r: r["o"]):
            key = r["g"] if by else 0
            total[key] = total.get(key, 0) + r["x"]
            assert r["x_upto"] == total[key]


def test_unit_hash_stays_in_range(spark):
    row = spark.range(1000).select(unit_hash(F.lit("s"), F.col("id")).alias("u")).agg(
        F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] < 0.01 and 0.99 < row[1] <= 1 and 0.45 < row[2] < 0.55


def test_only_accepted_versions_are_scored_with(spark, line, tmp_path):
    models, stages, scores = (str(tmp_path / n) for n in ("models", "stages", "scores"))
    good = training.fit_linear(line, ["a", "b"], "y")
    with pytest.raises(LookupError):
        training.load_accepted(spark, models, stages, "m")
    for shift in (0, 1e6):
        model = training.LinearModel(good.features, good.coefficients, good.intercept + shift)
        training.register_model(spark, models, "m", model)
        found = flows.validate_latest(spark, line, "y", models, stages, "m", limit=10.0).first()
        assert (found["version"], found["stage"]) == ((1, "accepted") if not shift else (2, "rejected"))
    with pytest.raises(ValueError, match="decided before"):
        flows.validate_latest(spark, line, "y", models, stages, "m", limit=1e9)
    training.register_model(spark, models, "m", good)
    with pytest.raises(ValueError, match="no complete rows"):
        flows.validate_latest(spark, line.where("k < 0"), "y", models, stages, "m")
    assert training.load_accepted(spark, models, stages, "m").intercept == pytest.approx(good.intercept)
    days = line.withColumn("Date", F.to_date(F.lit("2024-01-01")))
    flows.score_and_append(spark, days, models, "m", scores, day="2024-01-01", stages_path=stages)
    assert spark.read.parquet(scores).where("abs(predictions - y) > 1e-3").count() == 0
